"""Column names and business rules of one attrition study."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the studied project's rules (names as they appear in the data).
# Churn reasons left out of the churned set:
DEFAULT_EXCLUDED_REASONS = ("Bereavement", "HomeMove", "BadDebtDisconnect")
# CRM package names kept as their own category; every other name (and null) becomes "Other":
CRM_KEEP = ("Fibre 65 (FTTC-OR)", "Fibre 35 (FTTC-OR)", "Faster Fibre", "Fast Broadband",
            "Fibre 150 (GFast-OR)", "Broadband Only (SMPF)")
# The two Ultra names merged into the first one:
CRM_ULTRA = ("Ultra Fibre Optic", "Ultra Fibre Optic Broadband")
CRM_OTHER = "Other"
# Sales channel collapse, applied to the original value, first match wins; null stays null:
SALES_CHANNEL_MAP = (
    (("Other",), "Unknown"),
    (("Online - Search", "Online - Ambient"), "Online - Organic"),
    (("Field", "Online - Other", "Outbound"), "Other"),
)
# Package-speed columns dropped from gold as duplicates of other columns:
REDUNDANT_SPEED_COLUMNS = ("package_speed_18", "package_speed_65", "package_speed_40",
                           "package_speed_35", "package_speed_1000", "package_speed_150")
# One-hot groups validated in gold, by column-name prefix:
ONE_HOT_PREFIXES = ("contract_status_", "technology_", "package_speed_", "sales_channel_",
                    "crm_package_", "ooc_bucket_", "usage_days_bucket_")
# Columns that the second model leaves out besides id and label:
MODEL_2_DROP = ("ooc_bucket_minus100_to_50", "ooc_bucket_over_50", "ooc_bucket_under_minus100",
                "contract_dd_cancels", "dd_cancel_60_day")
MODEL_2_DROP_PREFIX = "contract_status_"
# Snapshot attributes in the order of the observation set (after id, behav_win, churned):
ATTRIBUTE_COLUMNS = ("contract_status", "contract_dd_cancels", "dd_cancel_60_day", "ooc_days",
                     "technology", "speed", "line_speed", "sales_channel", "crm_package_name",
                     "tenure_days")
# Base columns of gold next to the id:
GOLD_BASE = ("churned", "dd_cancel_60_day", "contract_dd_cancels", "line_speed", "tenure_days")


@dataclass(frozen=True)
class ChurnConfig:
    id_col: str = "unique_customer_identifier"
    month_col: str = "datevalue"              # first of month, customer_info snapshots
    behav_col: str = "behav_win"
    label_col: str = "churned"
    placed_col: str = "cease_placed_date"
    completed_col: str = "cease_completed_date"
    reason_col: str = "reason_description_insight"
    usage_date_col: str = "calendar_date"
    download_col: str = "usage_download_mbs"
    upload_col: str = "usage_upload_mbs"
    call_date_col: str = "event_date"
    seed: int = 42
    buffer_months: int = 3
    excluded_reasons: tuple = DEFAULT_EXCLUDED_REASONS
    attributes: tuple = ATTRIBUTE_COLUMNS

    @property
    def silver_columns(self) -> list:
        return [self.id_col, self.behav_col, self.label_col, *self.attributes]

    def with_(self, **kw) -> "ChurnConfig":
        from dataclasses import replace
        return replace(self, **kw)
