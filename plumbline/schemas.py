"""Fixed schemas of the engine's tables. Optional fields are nullable columns; `ord` is the order of arrival, on which ties are decided."""

from __future__ import annotations

FACT = (
    "ticker string, doc_id string, metric string, value decimal(24,6), previous_value decimal(24,6), comparatives array<decimal(24,6)>, multiplier decimal(24,6), "
    "confidence decimal(3,2), page int, fact_id string, period_months int, correction_id string, validation_status string, validation_notes string, extraction_method string, ord long"
)
DOCUMENT = "doc_id string, ticker string, kind string, title string, period_end date, publication_date date, url string, discovery_url string, period_months int, comparative_period_end date, ord long"
HISTORY = "ticker string, metric string, financial_year_end date, source_period_end date, value decimal(24,6), value_basis string, confidence decimal(3,2), correction_id string, source_document string, source_page int, ord long"
CORRECTION = "id string, status string, ticker string, metric string, financial_period date, source_document string, value decimal(24,6), unit string, source_page int, statement_scope string, source_text string, reason string, author string, corrected_at date"
SNAPSHOT = "trading_date date, ticker string, share_volume decimal(24,6), trade_count long, turnover decimal(24,6), last_traded_time long, source_url string, captured_utc timestamp"
REVIEW = "ticker string, company string, document string, metric string, rule string, severity string, page int, value string, candidates string, reason string, url string"
PAGE = "doc_id string, page_no int, text string, method string, image_count int"
COMPANY = "ticker string, name string, gics_sector string, industry_group string, profile_url string, classification_source_url string"

#: The metrics that every issuer is expected to report.
REQUIRED_METRICS = (
    "revenue", "operating_profit", "ebit", "net_profit", "net_profit_attributable", "eps", "dps", "total_assets", "total_liabilities", "total_equity", "ordinary_equity",
    "bvps", "cash", "retained_earnings", "total_debt", "operating_cash_flow", "capital_expenditure", "ordinary_shares_outstanding",
)
#: Flow metrics of the income and the cash-flow statement, and those that decide on a trailing basis.
INCOME_FLOWS = ("revenue", "operating_profit", "ebit", "net_profit", "net_profit_attributable", "eps")
CASH_FLOWS = ("operating_cash_flow", "capital_expenditure")
INCOME_ANCHORS = ("revenue", "net_profit", "eps")
HISTORY_METRICS = ("revenue", "net_profit", "eps", "dps", "total_equity", "operating_cash_flow")
GATE = "0.80"
