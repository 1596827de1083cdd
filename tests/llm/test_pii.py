"""Personal data: base spans against plain regular expressions, and disclosing terms."""

import hashlib
import math
import random
import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from odd_rows import no_documents, odd_documents  # noqa: E402

from tidesync.llm import pii  # noqa: E402

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def check(rows, text_of):
    for r in rows:
        spans = plain_spans(text_of[r.doc_id])
        n = Counter(o for _, o, _ in spans)
        base = ",".join(s for *_, s in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (text_of[r.doc_id], base, r)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in range(4))
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_query_equals_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = pii.op9_personal_data(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 50


def test_random_texts_of_the_patterns_alphabets(spark):
    rng = random.Random(1)
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "5500005555555559"]
    parts = ["a", "b.c", "@", ".", "x@y.z", "1", "12", "255.255.255.255", "256.1.1.1", "001.2.3.4", "+1", "(", ")", " ", " ", "-", "_", "%", "é", "漢", "🙂", "\n", "+44 20 7946 0958", "00000000000", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f", *cards]
    texts = {k: "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for k in range(600)}
    rows = pii.personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    check(rows, texts)


def test_many_spans_and_long_runs(spark):
    texts = {1: "1.2.3.4 " * 700 + "é", 2: "7" * 60_000, 3: "a.b" * 20_000, 4: "+" + "1 " * 30_000, 5: "x@" * 5000 + "y.z"}
    rows = pii.personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    check(rows, texts)
    assert {r.doc_id: r.n_ip for r in rows}[1] == 700


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = pii.personal_data(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() and r.spans == "" for r in rows)
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    assert sorted(map(str, clean.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    assert pii.personal_data(no_documents(spark)).count() == 0 and pii.sanitise(no_documents(spark)).count() == 0


def corpus():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    prose = [word() for _ in range(300)]
    rows = []
    for k in range(200):
        rows.append((k, " ".join(rng.choice(prose) for _ in range(30))))
    for k in range(6):  # Zoltan is met around one address only, in different words each time
        rows.append((500 + k, f"{' '.join(rng.choice(prose) for _ in range(9))} Zoltan zk@mail.example.com {' '.join(rng.choice(prose) for _ in range(9))}"))
    for _ in range(5):  # copies of one text are one surrounding, so they tell nothing
        rows.append((600, "unique Quirin qq@mail.example.com neighbour words"))
    rows.append((700, "Zoltan without any address"))
    return rows


def test_terms_that_disclose_an_entity(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, len(r[1]), "a", "b") for r in rows], "doc_id long, text string, n_chars long, terms string, t_id string")
    texts = dict(rows)
    found = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    assert len(pii.personal_data(docs).collect()) == len(rows)
    check(found.values(), texts)
    for k in range(6):
        at = texts[500 + k].index("Zoltan")
        assert f"term:{at}:{at + 6}" in found[500 + k].spans and "Zoltan" in texts[500 + k]
    assert "term" not in found[600].spans and found[700].spans == ""
    assert all("term" not in found[k].spans for k in range(200))
    clean = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert "Zoltan" not in clean[500].text and "[EMAIL]" in clean[500].text and clean[500].n_chars == len(clean[500].text)
    assert clean[700].text == texts[700] and "Quirin [EMAIL]" in clean[600].text
    assert all(clean[k].text == texts[k] for k in range(200))


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def spans_by_id(spark, rows):
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: r.spans for r in found}


def test_steady_words_around_an_entity_do_not_hide_a_name(spark):
    rng = random.Random(3)
    rows = [(k, prose(rng, 40)) for k in range(300)]
    rows += [(500 + k, f"{prose(rng, 20)} contact Jane Doe-Roe at jane@x.example.org {prose(rng, 20)} Jane's") for k in range(6)]
    base = f"{prose(rng, 30)} ask Quirin Quast about qq@x.example.org {prose(rng, 30)}".split()
    for k in range(12):  # near copies: another word replaced each time, of those around the address too
        words = list(base)
        words[30 + k - 6 if 30 + k - 6 not in (31, 32, 34) else 1] = prose(rng, 1)
        rows.append((600 + k, " ".join(words)))
    texts, spans = dict(rows), spans_by_id(spark, rows)
    for k in range(500, 506):
        for m in re.finditer(r"contact|\bJane\b|Doe-Roe", texts[k]):
            assert f"term:{m.start()}:{m.end()}" in spans[k]
    assert all("term" not in spans[k] for k in range(600, 612))


def test_a_name_beside_one_of_many_surroundings_of_a_shared_address(spark):
    rng = random.Random(4)
    rows = [(k, prose(rng, 40)) for k in range(1000)]
    rows += [(2000 + k, f"{prose(rng, 15)} {'Zoltan' if k < 10 else prose(rng, 1)} desk@x.example.org {prose(rng, 15)}") for k in range(100)]
    texts, spans = dict(rows), spans_by_id(spark, rows)
    n_t = Counter(w for t in texts.values() for w in set(t.split()))
    n_et = Counter(w for k in range(2000, 2100) for w in {*texts[k].split()[12:16], *texts[k].split()[17:21]})
    told = {w for w, n in n_et.items() if n >= 2 and math.log(n * 1100 / (100 * n_t[w])) >= pii.GENERALISE * math.log(11)}
    assert "Zoltan" in told and len(told) < 40
    for k, t in texts.items():
        want = {f"term:{m.start()}:{m.end()}" for m in re.finditer(r"\w+", t) if m.group() in told and k >= 2000}
        assert want == {x for x in spans[k].split(",") if x.startswith("term")}


def test_copies_of_one_text_leave_the_share_as_it_is(spark):
    rng = random.Random(5)
    rows = [(k, prose(rng, 30)) for k in range(300)]
    rows += [(500 + k, f"{prose(rng, 9)} Zoltan zk@x.example.org {prose(rng, 9)}") for k in range(6)]
    rows += [(1000 + k, rows[-1][1]) for k in range(100)]
    texts, spans = dict(rows), spans_by_id(spark, rows)
    for k in (500, 505, 1000, 1099):
        at = texts[k].index("Zoltan")
        assert f"term:{at}:{at + 6}" in spans[k]


def plain_disclosures(texts):
    """(value, term) -> share of the information, from counts over the distinct texts in plain loops."""
    texts = sorted(set(texts))
    spaces = re.compile(r"[\x20\x09-\x0D]+")
    letter = lambda c: c.isalpha()

    def bare(word):
        kept = [k for k, c in enumerate(word) if letter(c)]
        return word[kept[0] : kept[-1] + 1] if kept else ""

    usable = lambda t: len(t) > 2 and not re.search(r"[0-9@]", t)
    holds, near, has = Counter(), Counter(), Counter()
    for text in texts:
        hits = [m.group() for m in re.finditer(PLAIN["email"], text)]
        gaps = re.split(PLAIN["email"].replace("(", "(?:"), text)
        met = set()
        for k, e in enumerate(hits):
            words = [w for w in spaces.split(gaps[k]) if w][-pii.NEAR :] + [w for w in spaces.split(gaps[k + 1]) if w][: pii.NEAR]
            met |= {(e, bare(w)) for w in words if usable(bare(w))}
        near.update(met)
        holds.update(set(hits))
        has.update({bare(w) for w in spaces.split(text) if usable(bare(w))})
    n, out = len(texts), {}
    for (e, t), both in near.items():
        if both >= pii.MIN_CONTEXTS and holds[e] < n:
            share = math.log(both * n / (holds[e] * max(has[t], both))) / math.log(n / holds[e])
            if share >= pii.GENERALISE:
                out[e, t] = share
    return out


def test_disclosures_equal_plain_counts_on_shared_entities(spark):
    """Addresses that many different texts share, beside names that do or do not tell them."""
    rng = random.Random(31)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(7))
    people = [(f"user{k}@mail{k % 3}.example.org", f"Name{letters[k]}{letters[-k - 1]}", f"Team{letters[k % 4]}") for k in range(14)]
    texts = []
    for _ in range(420):
        words = [word() for _ in range(rng.randint(20, 50))]
        for address, name, team in rng.sample(people, rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(words))
            words[at:at] = [team if rng.random() < 0.6 else word(), (name if rng.random() < 0.8 else word()) + ",", address, rng.choice(["today", "office", word()])]
        if rng.random() < 0.2:
            words.append(rng.choice(people)[1])  # a name without its address
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts + texts[:50])], "doc_id long, text string")  # copies count once
    found = pii.located(docs)
    marked = pii.marked(found)
    assert pii.copy_classes(marked.where("size(spans) > 0")).count() == 0  # no near copies, so every text is evidence of its own
    got = {(r.value, r.term): r.share for r in pii.disclosures(docs, found, marked).collect()}
    want = plain_disclosures(texts)
    assert len(want) > 10 and set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {t for _, t in got} & {n for _, n, _ in people}
