"""Registry of standard financial concepts: which filing tags mean which metric, in order of preference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_G, _U, _S, _E = "us-gaap", "USD", "shares", "USD/shares"
# Metric, kind (flow or instant), adds up over quarters, outflow shown positive, tags by preference.
CONCEPTS = [
    ("revenue", "flow", True, False, ["RevenueFromContractWithCustomerExcludingAssessedTax", "RevenuesNetOfInterestExpense", "RegulatedAndUnregulatedOperatingRevenue", "RevenueFromContractWithCustomerIncludingAssessedTax", "Revenues", "SalesRevenueNet", "SalesRevenueGoodsNet", "SalesRevenueServicesNet"]),
    ("cost_of_revenue", "flow", True, False, ["CostOfRevenue", "CostOfGoodsAndServicesSold", "CostOfGoodsSold"]),
    ("gross_profit", "flow", True, False, ["GrossProfit"]),
    ("operating_income", "flow", True, False, ["OperatingIncomeLoss"]),
    ("net_income", "flow", True, False, ["NetIncomeLoss", "ProfitLoss", "NetIncomeLossAvailableToCommonStockholdersBasic"]),
    ("interest_expense", "flow", True, False, ["InterestExpenseNonOperating", "InterestAndDebtExpense", "InterestExpense"]),
    ("income_tax_expense", "flow", True, False, ["IncomeTaxExpenseBenefit", "CurrentIncomeTaxExpenseBenefit"]),
    ("diluted_eps", "flow", False, False, [(_G, "EarningsPerShareDiluted", _E), (_G, "IncomeLossFromContinuingOperationsPerDilutedShare", _E)]),
    ("cash_and_equivalents", "instant", False, False, ["CashAndCashEquivalentsAtCarryingValue", "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", "CashAndDueFromBanks"]),
    ("short_term_investments", "instant", False, False, ["ShortTermInvestments", "MarketableSecuritiesCurrent"]),
    ("total_assets", "instant", False, False, ["Assets"]),
    ("current_assets", "instant", False, False, ["AssetsCurrent"]),
    ("total_liabilities", "instant", False, False, ["Liabilities"]),
    ("current_liabilities", "instant", False, False, ["LiabilitiesCurrent"]),
    ("short_term_debt", "instant", False, False, ["ShortTermBorrowings", "ShortTermDebtCurrent", "LongTermDebtCurrent", "LongTermDebtAndFinanceLeaseObligationsCurrent"]),
    ("long_term_debt", "instant", False, False, ["LongTermDebtNoncurrent", "LongTermDebtAndFinanceLeaseObligationsNoncurrent", "LongTermDebt"]),
    ("total_debt", "instant", False, False, ["LongTermDebtAndFinanceLeaseObligations", "LongTermDebtAndCapitalLeaseObligations"]),
    ("stockholders_equity", "instant", False, False, ["StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "PartnersCapital"]),
    ("shares_outstanding", "instant", False, False, [("dei", "EntityCommonStockSharesOutstanding", _S), (_G, "CommonStockSharesOutstanding", _S)]),
    ("operating_cash_flow", "flow", True, False, ["NetCashProvidedByUsedInOperatingActivities", "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations"]),
    ("capital_expenditure", "flow", True, True, ["PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsToAcquireOtherPropertyPlantAndEquipment", "PaymentsForAdditionsToPropertyPlantAndEquipment", "PaymentsToAcquireProductiveAssets"]),
    ("depreciation_and_amortization", "flow", True, False, ["DepreciationDepletionAndAmortization", "DepreciationDepletionAndAmortizationPropertyPlantAndEquipment", "Depreciation"]),
    ("stock_based_compensation", "flow", True, False, ["ShareBasedCompensation", "AllocatedShareBasedCompensationExpense"]),
    ("dividends_paid", "flow", True, True, ["PaymentsOfDividends", "PaymentsOfDividendsCommonStock", "PaymentsOfOrdinaryDividends"]),
    ("share_repurchases", "flow", True, True, ["PaymentsForRepurchaseOfCommonStock", "PaymentsForRepurchaseOfEquity"]),
]
# Metrics that do not apply to a business model.
_LENDER = ["cost_of_revenue", "gross_profit", "current_assets", "current_liabilities", "operating_cash_flow", "capital_expenditure", "free_cash_flow", "gross_margin", "operating_cash_flow_margin", "free_cash_flow_margin", "current_ratio"]
NOT_APPLICABLE = {"bank": _LENDER, "insurance": _LENDER, "reit": ["capital_expenditure", "free_cash_flow", "free_cash_flow_margin"], "utility": [], "non_financial": []}
# Flags that a standardized row may carry.
QUALITY_FLAGS = ["missing_revenue", "missing_net_income", "conflicting_candidate_tags", "unsupported_custom_taxonomy", "period_classification_ambiguous", "quarter_derived_from_ytd", "q4_derived_from_fy", "quarter_derivation_incomplete", "ttm_incomplete", "future_period_fact_excluded", "unlinked_accession", "negative_equity", "not_applicable_for_business_model"]

FLOWS = [c[0] for c in CONCEPTS if c[1] == "flow"]
INSTANTS = [c[0] for c in CONCEPTS if c[1] == "instant"]
ADDITIVE = [c[0] for c in CONCEPTS if c[2]]
METRICS = [c[0] for c in CONCEPTS]
BASE_METRICS = [*METRICS[: METRICS.index("depreciation_and_amortization")], "free_cash_flow", *METRICS[METRICS.index("depreciation_and_amortization") :]]
RATIOS = [
    ("gross_margin", "gross_profit", "revenue"),
    ("operating_margin", "operating_income", "revenue"),
    ("net_margin", "net_income", "revenue"),
    ("operating_cash_flow_margin", "operating_cash_flow", "revenue"),
    ("free_cash_flow_margin", "free_cash_flow", "revenue"),
    ("debt_to_assets", "total_debt", "total_assets"),
    ("debt_to_equity", "total_debt", "stockholders_equity"),
    ("current_ratio", "current_assets", "current_liabilities"),
]


def registry(spark: SparkSession) -> DataFrame:
    """taxonomy, tag, unit, metric, priority, kind, additive, expenditure: some seventy rows, broadcast in joins."""
    rows = []
    for metric, kind, additive, spent, tags in CONCEPTS:
        for k, tag in enumerate(tags):
            taxonomy, name, unit = tag if isinstance(tag, tuple) else (_G, tag, _U)
            rows.append((taxonomy, name, unit, metric, k, kind, additive, spent))
    return spark.createDataFrame(rows, "taxonomy string, tag string, unit string, metric string, priority int, kind string, additive boolean, expenditure boolean")
