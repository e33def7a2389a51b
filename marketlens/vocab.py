"""Fixed values.

Everything in this module is data that has to equal the marketplace's own
vocabulary for results to be right: fee-group labels as they are stored in
fee rows, the keywords that classify a service name into a group, the
service codes that get readable names, and the source tags. They are kept
here, plainly and together, in their natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: fee groups, as stored in fee rows -------------------------
FEE_GROUP_COMMISSION = "Вознаграждение Ozon"
FEE_GROUP_DELIVERY = "Услуги доставки"
FEE_GROUP_ACQUIRING = "Услуги агентов"
FEE_GROUP_ADS = "Продвижение и реклама"
FEE_GROUP_OTHER = "Прочее"
FEE_GROUP_DISCOUNT = "Скидки"
FEE_GROUP_SALES = "Продажи"

# --- FIXED VALUES: classification of a service name into a fee group ---------
# Case-insensitive "contains any" test, evaluated top-down; first match wins;
# nothing matched -> FEE_GROUP_OTHER.
FEE_GROUP_RULES: list[tuple[str, list[str]]] = [
    (FEE_GROUP_COMMISSION, ["вознаграж", "комисс", "commission"]),
    (FEE_GROUP_DELIVERY, ["logistic", "логист", "достав", "last mile", "courier"]),
    (FEE_GROUP_ACQUIRING, ["эквайр", "acquiring"]),
    (FEE_GROUP_ADS, ["клик", "cpc", "cpo", "реклам", "продвиж"]),
]

# --- FIXED VALUES: readable names for three service codes --------------------
FEE_NAME_MAP: dict[str, str] = {
    "MarketplaceServiceItemDirectFlowLogistic": "Логистика (доставка)",
    "MarketplaceServiceItemRedistributionLastMileCourier": "Последняя миля (курьер)",
    "MarketplaceRedistributionOfAcquiringOperation": "Эквайринг",
}
FEE_NAME_UNKNOWN = "UNKNOWN"

# --- FIXED VALUES: fee rows derived from a posting's financial data ----------
POSTING_COMMISSION_NAME = "Вознаграждение за продажу"
POSTING_DISCOUNT_NAME = "Скидка"

# --- FIXED VALUES: source tags of fee / attribution rows ---------------------
SOURCE_POSTING = "posting_financial"
SOURCE_FINANCE_API = "finance_api"
SOURCE_FINANCE_REPORT = "finance_report"
SOURCE_PERFORMANCE = "performance_api"

# --- FIXED VALUES: defaults ---------------------------------------------------
UNKNOWN_CUSTOMER = "unknown"
UNKNOWN_CAMPAIGN_ID = "0"
LOOKBACK_DAYS = 30

# Breakdown buckets of the per-order fee pivot: output column -> fee group.
# Rows whose group is none of these (and not NULL) land in other_fee.
FEE_BUCKETS: list[tuple[str, str]] = [
    ("delivery_fee", FEE_GROUP_DELIVERY),
    ("acquiring_fee", FEE_GROUP_ACQUIRING),
    ("ads_fee", FEE_GROUP_ADS),
    ("sale_commission", FEE_GROUP_COMMISSION),
    ("discount", FEE_GROUP_DISCOUNT),
]

# Regular expression for a full posting number (customer-number-part).
POSTING_NUMBER_PATTERN = r"^\d+-\d+-\d+$"

# --- FIXED VALUES: accrual report header labels -> column names ---------------
ACCRUAL_LABELS: dict[str, str] = {
    "ID начисления": "accrual_id",
    "Дата начисления": "accrual_date",
    "Группа услуг": "service_group",
    "Тип начисления": "accrual_type",
    "SKU": "sku",
    "Дата принятия заказа в обработку или оказания услуги": "accepted_at",
    "Сумма итого, руб.": "total_amount",
    "Вознаграждение Ozon, %": "commission_percent",
}
