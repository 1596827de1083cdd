"""The nine record types of the inventory / manufacturing snapshots.

Fixed values: source keys, declared types, required flags and merge keys below
must equal the source system's record declarations for results to agree. Field
names are derived from the source key by :func:`tidesync.spec.snake_name`;
``name=`` is given only where the declared name departs from that rule.
"""

from __future__ import annotations

from tidesync.spec import FieldSpec, TableSpec

STR = ("str",)
INT = ("int",)
DATETIME_OR_TEXT = ("datetime", "str")  # lands in a TIMESTAMP column
TEXT_OR_DATETIME = ("str", "datetime")  # stays text


def _f(source: str, declared: tuple[str, ...] = STR, required: bool = False, name: str = "") -> FieldSpec:
    return FieldSpec(source=source, declared=declared, required=required, name=name)


MATERIALS = TableSpec(
    name="materials_query",
    keys=("part_number",),
    zero_date_to_null=False,
    fields=(
        _f("PartNumber", required=True),
        _f("MaterialName"),
        _f("Type", name="material_type"),
        _f("Unit"),
        _f("MaterialId"),
        _f("Description"),
        _f("Cost"),
        _f("Account"),
        _f("StorageCondition"),
        _f("RecomendedShelfLife"),
        _f("RetestPeriod"),
        _f("ExpiryPeriod"),
        _f("AlertLevelQuantity"),
        _f("ReorderLevelQuantity"),
        _f("OrderLeadTime", INT),
        _f("MaterialHidden", INT),
        _f("MaterialMasterData", INT),
    ),
)

SPECIFICATIONS = TableSpec(
    name="specifications_query",
    keys=("part_number", "version"),
    fields=(
        _f("PartNumber", required=True),
        _f("MaterialName"),
        _f("Version", required=True),
        _f("Unit"),
        _f("Type", name="specification_type"),
        _f("EffectiveDate", DATETIME_OR_TEXT),
        _f("Hidden", INT),
    ),
)

MATERIALS_PLANNED = TableSpec(
    name="materials_planned_query",
    keys=("material_planned_id",),
    fields=(
        _f("MaterialPlannedId", required=True),
        _f("PartNumber"),
        _f("Version"),
        _f("MaterialName"),
        _f("Unit"),
        _f("QuantityNeeded"),
        _f("OrderBy", DATETIME_OR_TEXT),
        _f("NeedBy", DATETIME_OR_TEXT),
        _f("VendorId"),
        _f("VendorName"),
    ),
)

REQUISITIONS = TableSpec(
    name="requisitions_query",
    keys=("requisition_number", "part_number", "version"),
    fields=(
        _f("RequisitionNumber", required=True),
        _f("StatusId", INT),
        _f("StatusName"),
        _f("PartNumber", required=True),
        _f("Version", required=True),
        _f("POnumber", name="po_number"),
        _f("MaterialName"),
        _f("MaterialId"),
        _f("VendorId"),
        _f("VendorName"),
        _f("ItemQuantity"),
        _f("ItemQuantityUnit"),
        _f("RequestedByPersonId"),
        _f("RequestedByPersonDescription"),
        _f("RequestedByDateTime", DATETIME_OR_TEXT),
        _f("OrderBy", DATETIME_OR_TEXT),
        _f("NeededBy", DATETIME_OR_TEXT),
        _f("ApprovedByPersonId"),
        _f("ApprovedByPersonDescription"),
        _f("ApprovedByDateTime", DATETIME_OR_TEXT),
    ),
)

PENDING_RECEIPTS = TableSpec(
    name="pending_receipts_query",
    keys=("receipt_number",),
    fields=(
        _f("ReceiptNumber", required=True),
        _f("PartNumber"),
        _f("Version"),
        _f("MaterialName"),
        _f("MaterialId"),
        _f("VendorName"),
        _f("Project"),
        _f("RequisitionNumber"),
        _f("PurchaseOrderNumber"),
        _f("QuantityOrd"),
        _f("QuantityRcv"),
        _f("Unit"),
        _f("NeededBy", DATETIME_OR_TEXT),
        _f("FulfillmentDate2Nd", DATETIME_OR_TEXT, name="fulfillment_date_2nd"),
        _f("FulfillmentDate3Rd", DATETIME_OR_TEXT, name="fulfillment_date_3rd"),
        _f("FulfillmentDate4Th", DATETIME_OR_TEXT, name="fulfillment_date_4th"),
        _f("VendorPartNumber"),
        _f("CatalogNumber"),
        _f("Status"),
    ),
)

INVENTORY = TableSpec(
    name="inventory_query",
    keys=("inventory_receipt_number",),
    fields=(
        _f("InventoryReceiptNumber", required=True),
        _f("PartNumber"),
        _f("Version"),
        _f("ReceiptNumber"),
        _f("SplitFrom"),
        _f("RequisitionNumber"),
        _f("PurchaseOrderNumber"),
        _f("MaterialName"),
        _f("MaterialId"),
        _f("VendorName"),
        _f("Project"),
        _f("VendorLotNumber"),
        _f("InternalLotNumber"),
        _f("BatchNumber"),
        _f("ProductionNumber"),
        _f("QuantityReceived"),
        _f("QuantityReceivedUnit"),
        _f("QuantityRemain"),
        _f("QuantityRemainUnit"),
        _f("ReceivedDate", DATETIME_OR_TEXT),
        _f("InventoryStatusId"),
        _f("InventoryStatusName"),
        _f("UseBy", DATETIME_OR_TEXT),
        _f("RetestDate", DATETIME_OR_TEXT),
        _f("ExpiryDate", DATETIME_OR_TEXT),
        _f("BinLocation"),
        _f("ProductName"),
        _f("VendorPartNumber"),
        _f("CatalogNumber"),
        _f("Cost"),
        _f("MaterialType"),
        _f("FullRetestDate", DATETIME_OR_TEXT),
        _f("MicroRetestDate", DATETIME_OR_TEXT),
        _f("ImpurityRetestDate", DATETIME_OR_TEXT),
        _f("MFGRetestDate", DATETIME_OR_TEXT),
        _f("MFGExpiryDate", DATETIME_OR_TEXT),
        _f("InternalExpiryDate", DATETIME_OR_TEXT),
        _f("FacilityId"),
        _f("RoomId"),
        _f("BinId"),
    ),
)

INVENTORY_USAGE = TableSpec(
    name="inventory_usage",
    keys=("inventory_receipt_number", "usage_sequence"),
    fields=(
        _f("InventoryReceiptNumber", required=True),
        _f("UsageSequence", INT, required=True),
        _f("UsedDate", DATETIME_OR_TEXT),
        _f("UsedProductionNumber"),
        _f("UsedBatchNumber"),
        _f("UsedQuantity"),
        _f("UsedQuantityUnit"),
        _f("Purpose"),
        _f("QuantityRemain"),
        _f("QuantityRemainUnit"),
        _f("ApprovedByPersonId"),
        _f("ApprovedByPersonDescription"),
        _f("ApprovedDateTime", DATETIME_OR_TEXT),
        _f("BinLocation"),
        _f("Action"),
        _f("SplitToReceiptNumber"),
        _f("NewStatus"),
        _f("Project"),
        _f("PicklistName"),
        _f("ShippingManifestName"),
        _f("AdjustmentReason"),
        _f("VendorPartNumber"),
        _f("CatalogNumber"),
        _f("NewCost"),
        _f("OldVendorLotNumber"),
        _f("FacilityId"),
        _f("RoomId"),
        _f("BinId"),
    ),
)

BATCH_PRODUCTION_RECORD = TableSpec(
    name="batch_production_record",
    keys=("bpr_id", "mpr_number", "mpr_version_number"),
    dedup_rows=True,
    fields=(
        _f("BprId", INT, required=True),
        _f("ProjectTitle"),
        _f("MPRVersionId"),
        _f("StatusId", INT),
        _f("StatusName"),
        _f("CreationDate", TEXT_OR_DATETIME),
        _f("IssueDate", TEXT_OR_DATETIME),
        _f("ProductionDate", TEXT_OR_DATETIME),
        _f("PlannedProductionDate", TEXT_OR_DATETIME),
        _f("ReviewStarted", TEXT_OR_DATETIME),
        _f("ProductName"),
        _f("TheoreticalBatchYield"),
        _f("BatchSize"),
        _f("BatchUnitName"),
        _f("MPRNumber", required=True),
        _f("MPRVersionNumber", required=True),
        _f("BatchNumber"),
        _f("ProductionNumber"),
        _f("FormulationId"),
        _f("PartNumber"),
        _f("MaterialName"),
        _f("MaterialVersionNumber"),
        _f("MaterialType"),
        _f("ClientName"),
    ),
)

MASTER_PRODUCTION_RECORD = TableSpec(
    name="master_production_record",
    keys=("mpr_number", "mpr_version_number"),
    fields=(
        _f("ProjectTitle"),
        _f("MPRVersionId"),
        _f("DMS"),
        _f("StatusId", INT),
        _f("StatusName"),
        _f("CreationDate", TEXT_OR_DATETIME),
        _f("ProductName"),
        _f("MPRNumber", required=True),
        _f("MPRVersionNumber", required=True),
        _f("ClientId"),
        _f("ClientName"),
        _f("AuthorPersonId"),
        _f("AuthorPersonFullName"),
        _f("FormulationId"),
        _f("TheoreticalBatchYield"),
        _f("BatchSize"),
        _f("BatchUnitId"),
        _f("BatchUnitName"),
        _f("PartNumber"),
        _f("MaterialName"),
        _f("MatVersionNumber"),
        _f("MaterialTypeId"),
        _f("MaterialTypeName"),
        _f("ReasonForChange"),
    ),
)

ALL_SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        MATERIALS,
        SPECIFICATIONS,
        MATERIALS_PLANNED,
        REQUISITIONS,
        PENDING_RECEIPTS,
        INVENTORY,
        INVENTORY_USAGE,
        BATCH_PRODUCTION_RECORD,
        MASTER_PRODUCTION_RECORD,
    )
}

_NO_FIELD = "records have no such field"

# Request filters whose names do not follow from a field's name
# (see operators.filters.request_filter), per table: (test, field).
REQUEST_FILTERS: dict[str, dict[str, tuple[str, str]]] = {
    MATERIALS.name: {"TypesContains": ("contains", "material_type")},
    SPECIFICATIONS.name: {"TypesContains": ("contains", "specification_type")},
    REQUISITIONS.name: {
        "Status": ("equals", "status_name"),
        "FromApprovalDate": ("from", "approved_by_date_time"),
        "ToApprovalDate": ("to", "approved_by_date_time"),
    },
    INVENTORY.name: {"StatusId": ("equals", "inventory_status_id")},
    # The service does not say which of a batch's dates it bounds; here it is the creation date.
    BATCH_PRODUCTION_RECORD.name: {"From": ("from", "creation_date"), "To": ("to", "creation_date")},
}

# Request filters that no record field can answer, and why.
REFUSED_FILTERS: dict[str, dict[str, str]] = {
    SPECIFICATIONS.name: {"StatusFilter": _NO_FIELD, "MaterialType": "records have the specification's type only"},
    REQUISITIONS.name: {"Hidden": _NO_FIELD},
    PENDING_RECEIPTS.name: {"ShowReceipt": _NO_FIELD},
    INVENTORY.name: {
        "FromApprovalDate": _NO_FIELD,
        "ToApprovalDate": _NO_FIELD,
        "MaterialSystemType": _NO_FIELD,
        "ShowDepletedInventory": "it selects a snapshot; read the landed 'depleted' folder instead",
    },
    BATCH_PRODUCTION_RECORD.name: {"BPRNumber": _NO_FIELD, "ProductNumber": _NO_FIELD, "UsersPersonId": _NO_FIELD, "Hidden": _NO_FIELD},
    MASTER_PRODUCTION_RECORD.name: {"UsersPersonId": _NO_FIELD, "Hidden": _NO_FIELD},
}
