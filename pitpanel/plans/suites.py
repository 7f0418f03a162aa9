"""Standard suites: raw, clean and merged checkpoints with thresholds that tighten step by step."""

from __future__ import annotations

from pitpanel.operators.expectations import (
    Expectation, between, columns_between, distinct_between, exist, in_set, max_between, mean_between, not_null,
    of_type, rows_between, rows_equal_other, stdev_between, unique, unique_together,
)

# fixed values: the bounds below are part of the suites' meaning
SECTORS = ("Financials", "Technology", "Communication Services", "Consumer Discretionary", "Consumer Staples", "Energy",
           "Healthcare", "Industrials", "Materials")

FIRST_MACRO = [
    *exist("GDP_Growth", "CPI_Inflation", "Unemployment_Rate", "Federal_Funds_Rate"),
    *between("GDP_Growth", -20, 20, 0.95), *between("CPI_Inflation", -5, 20, 0.95),
    *between("Unemployment_Rate", 0, 30, 0.95), *between("Federal_Funds_Rate", 0, 25, 0.95),
    *not_null("GDP_Growth", mostly=0.5), *rows_between(100, None),
]
FIRST_MARKET = [
    *exist("VIX"), *between("VIX", 0, 100, 0.99), *not_null("VIX", mostly=0.9), *exist("SP500"),
    *between("SP500", 0, 10000, 0.99), *between("SP500_Return", -20, 20, 0.95), *rows_between(1000, None),
]
FIRST_COMPANY = [
    *exist("Company", "Sector", "Stock_Price"), *between("Stock_Price", 0, 10000, 0.99),
    *not_null("Stock_Price", mostly=0.95), *not_null("Company"), *in_set("Sector", SECTORS),
    *between("Stock_Return", -50, 50, 0.95), *rows_between(1000, None),
]
RAW_MACRO = [
    *exist("Date", "GDP", "CPI", "Unemployment_Rate"), *between("GDP", 5000, 35000, 0.90), *between("CPI", 150, 400, 0.90),
    *between("Unemployment_Rate", 0, 30, 0.95), *not_null("Unemployment_Rate", mostly=0.80), *rows_between(1000, 10000),
]
RAW_MARKET = [
    *exist("VIX", "SP500"), *between("VIX", 5, 100, 0.99), *between("SP500", 500, 10000, 0.99), *rows_between(1000, 10000),
]
RAW_PRICES = [
    *exist("Open", "Close", "Volume", "Company"), *between("Close", 0.01, 10000, 0.99), *not_null("Company"),
    *rows_between(10000, 200000),
]
RAW_BALANCE = [
    *exist("Total_Assets", "Total_Liabilities", "Company"), *between("Total_Assets", 1e6, 1e13, 0.70), *not_null("Company"),
    *rows_between(50, 5000),
]
RAW_INCOME = [
    *exist("Revenue", "Net_Income", "Company"), *between("Revenue", 0, 1e12, 0.70), *not_null("Company"),
    *rows_between(50, 5000),
]
CLEAN_MACRO_SHORT = [
    *exist("GDP", "CPI"), *not_null("GDP", "CPI", mostly=0.95), *unique("Date"), *rows_between(1000, 10000),
]
_MACRO_NUMERIC = ("GDP", "CPI", "Unemployment_Rate", "Federal_Funds_Rate", "Yield_Curve_Spread", "Oil_Price")
CLEAN_MACRO = [
    *rows_between(1000, 10000), *columns_between(10, 20),
    *exist("Date", "GDP", "CPI", "Unemployment_Rate", "Federal_Funds_Rate"), *not_null("Date"), *unique("Date"),
    *[e for c in _MACRO_NUMERIC for e in (*not_null(c, mostly=0.99), *of_type(c, "double"))],
    *between("GDP", 5000, 35000, 0.95), *between("CPI", 0, 600, 0.95), *between("Unemployment_Rate", 0, 30, 0.95),
    *between("Federal_Funds_Rate", -5, 30, 0.95), *between("Oil_Price", 0, 500, 0.95),
    *[e for c in _MACRO_NUMERIC for e in stdev_between(c, 0.01, None)], *rows_equal_other(),
]
CLEAN_MARKET = [
    *rows_between(1000, 10000), *exist("Date", "VIX", "SP500_Close"), *not_null("Date", "VIX", "SP500_Close", mostly=0.99),
    *unique("Date"), *between("VIX", 5, 100, 0.99), *mean_between("VIX", 10, 30), *between("SP500_Close", 500, 10000, 0.99),
]
CLEAN_PRICES = [
    *rows_between(10000, 200000), *exist("Date", "Company", "Stock_Price"),
    *not_null("Date", "Company", "Stock_Price", mostly=0.99), *distinct_between("Company", 2, 50),
    *between("Stock_Price", 0.01, 1000, 0.99), *of_type("Stock_Price", "double"), *unique_together("Date", "Company"),
]
CLEAN_BALANCE = [
    *rows_between(50, 500), *exist("Date", "Company", "Total_Assets", "Total_Debt", "Total_Equity"),
    *not_null("Total_Assets", "Total_Equity", "Total_Debt", mostly=0.95), *between("Total_Assets", 1e9, 1e14, 0.95),
    *between("Total_Debt", 0, 1e13, 0.95), *unique_together("Date", "Company"),
]
CLEAN_INCOME = [
    *rows_between(50, 500), *exist("Date", "Company", "Revenue", "Net_Income"), *not_null("Revenue", "Net_Income", mostly=0.95),
    *between("Revenue", 1e8, 1e12, 0.95), *between("Net_Income", -1e11, 1e11, 0.95), *unique_together("Date", "Company"),
]


def merged_macro(first_day: str, last_day: str) -> list[Expectation]:
    """``first_day``/``last_day`` bound the newest date: a freshness check against the run date."""
    columns = ("Date", "GDP", "CPI", "Unemployment_Rate", "Federal_Funds_Rate", "VIX", "SP500_Close")
    return [
        *rows_between(3000, 10000), *columns_between(30, 150),
        *[e for c in columns for e in (*exist(c), *not_null(c, mostly=0.95))],
        *between("GDP", 10000, 30000, 0.95), *between("CPI", 0, 500, 0.95), *between("Unemployment_Rate", 0, 30, 0.95),
        *between("Federal_Funds_Rate", -5, 25, 0.95), *between("VIX", 5, 100, 0.95), *between("SP500_Close", 500, 10000, 0.95),
        *max_between("Date", first_day, last_day),
    ]


def merged_panel(companies: tuple[str, ...]) -> list[Expectation]:
    return [
        *rows_between(5000, 50000), *columns_between(50, 200),
        *exist("Date", "Company", "Sector", "GDP", "VIX", "Stock_Price", "Revenue", "Net_Income"), *not_null("Company"),
        *distinct_between("Company", len(companies), len(companies)), *in_set("Company", companies),
        *between("Stock_Price", 0.01, 1000, 0.95), *between("Revenue", 1e9, 1e12, 0.95), *between("Net_Income", -1e11, 1e11, 0.95),
        *between("Total_Assets", 1e10, 1e13, 0.95), *between("Total_Debt", 0, 1e12, 0.95),
        *between("Profit_Margin", -1, 1, 0.90), *between("ROE", -2, 2, 0.90), *between("ROA", -1, 1, 0.90),
        *between("Debt_to_Equity", 0, 50, 0.90),
    ]


CLEAN_MERGED_MACRO = [
    *exist("Date", "GDP", "CPI", "VIX"), *not_null("GDP", "CPI", "VIX", "Unemployment_Rate", mostly=0.99),
    *between("GDP", 5000, 35000, 0.99), *between("CPI", 150, 400, 0.99), *between("VIX", 5, 100, 0.99), *unique("Date"),
    *rows_between(3000, 10000), *columns_between(40, 120),
]
CLEAN_MERGED_PANEL = [
    *exist("Date", "Company", "GDP", "VIX"), *not_null("Company"), *distinct_between("Company", 2, 50),
    *unique_together("Date", "Company"), *not_null("GDP", "VIX", mostly=0.99), *between("GDP", 5000, 35000, 0.99),
    *between("VIX", 5, 100, 0.99), *between("Profit_Margin", -100, 100, 0.95), *between("ROE", -200, 200, 0.95),
    *between("Debt_to_Equity", 0, 100, 0.95), *rows_between(5000, 300000), *columns_between(40, 200),
]
