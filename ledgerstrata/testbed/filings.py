"""Maps supplier line items to company filings (see FIXTURES.md, section 4).

A supplier is a company and a calendar quarter of its line items a fiscal
quarter. Money is counted in exact integers of 1/100 cent, so that every engine
gets the same double whatever the order of addition.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tickers of the first ten companies, and the year shift that
# moves the ship dates onto the years the queries ask for.
TICKERS = ("AAPL", "MSFT", "GOOGL", "AMZN", "META", "NKE", "HD", "TGT", "WMT", "NVDA")
YEAR_SHIFT = 23

# Companies whose documents, some 120 KB each, one task writes into one packed file.
TASK_COMPANIES = 500

REVENUE_CONCEPTS = ("Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cik, name, ticker, exchange and SIC code per supplier."""
    supplier = _table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    listed = F.element_at(F.array(*[F.lit(t) for t in TICKERS]), (key + 1).cast("int"))
    other = F.concat(F.lit("S"), F.lpad(key.cast("string"), 5, "0"))
    sic = sic_map(spark, sf_dir)
    return (
        supplier.withColumn("sic_code", F.lpad(F.col("s_nationkey").cast("string"), 4, "0"))
        .join(sic, "sic_code", "left")
        .select(
            "s_suppkey",
            key.cast("string").alias("cik"),
            F.col("s_name").alias("company_name"),
            F.when(key.between(0, len(TICKERS) - 1), listed).otherwise(other).alias("ticker"),
            F.col("sector").alias("exchange"),
            "sic_code",
        )
    )


def sic_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation as SIC code and industry, region as sector."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("sic_code"),
        F.col("n_name").alias("industry"),
        F.col("r_name").alias("sector"),
    )


def _periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer sums per company and period: quarters plus their full-year sum.

    The rows lie by ``cik`` in as many partitions as shuffles have, or in more where one
    would hold more than ``TASK_COMPANIES``.
    """
    parts = ceil(_table(spark, sf_dir, "supplier").count() / TASK_COMPANIES)
    item = _table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        (F.year("l_shipdate") + YEAR_SHIFT).alias("fiscal_year"),
        F.concat(F.lit("Q"), F.quarter("l_shipdate").cast("string")).alias("fiscal_period"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("c"),
        F.round(F.col("l_discount") * 100).cast("long").alias("d"),
        F.round(F.col("l_tax") * 100).cast("long").alias("t"),
        F.col("l_quantity").cast("long").alias("q"),
        "l_returnflag",
        "l_linestatus",
    )

    def part(column: str, value: str) -> Column:
        return F.sum(F.when(F.col(column) == value, F.col("c")).otherwise(F.lit(0)))

    sums = {
        "c": F.sum("c"),
        "cd": F.sum(F.col("c") * F.col("d")),
        "ct": F.sum(F.col("c") * F.col("t")),
        "cq": F.sum(F.col("c") * F.col("q")),
        "q": F.sum("q"),
        "returned": part("l_returnflag", "R"),
        "accepted": part("l_returnflag", "A"),
        "fresh": part("l_returnflag", "N"),
        "open": part("l_linestatus", "O"),
        "filled": part("l_linestatus", "F"),
    }
    quarters = (
        item.groupBy("l_suppkey", "fiscal_year", "fiscal_period")
        .agg(*[s.alias(n) for n, s in sums.items()])
        # Wide enough for any number of items once the few sums are combined.
        .withColumns({n: F.col(n).cast("decimal(25,0)") for n in sums})
    )
    # Dealt by company once: the full years, the company's attributes and whatever groups
    # its long rows by company and more need no further shuffle. Each period row becomes
    # some 25 rows, and a fixed number of partitions keeps adaptive coalescing from
    # judging by the small input.
    dealt = quarters.withColumn("cik", F.col("l_suppkey").cast("string")).repartition(
        max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))), "cik"
    )
    period = F.explode(F.array(F.col("fiscal_period"), F.lit("FY")))
    names = list(sums)
    return (
        dealt.select("cik", "fiscal_year", period.alias("fiscal_period"), *names)
        .groupBy("cik", "fiscal_year", "fiscal_period")
        .agg(*[F.sum(n).alias(n) for n in names])
    )


def _concepts() -> list[tuple[str, str, Column]]:
    """(concept, unit, value); a NULL value means not reported."""
    key = F.col("s_suppkey")
    col = {n: F.col(n) for n in ("c", "cd", "ct", "cq", "q", "returned", "accepted", "fresh", "open", "filled")}
    c, cd, ct = col["c"], col["cd"], col["ct"]

    def every(n: int) -> Column:
        return key % n == 0

    revenue = c * 100
    cost = c * 40 + cd * 3
    gross = revenue - cost
    expenses = c * 10 + ct * 2
    operating = gross - expenses
    interest = col["open"] * 2
    net = operating - interest - col["returned"] * 60
    assets = c * 150
    liabilities = c * 60 + cd * 8
    usd = [
        ("Revenues", F.when(~every(3), revenue)),
        ("RevenueFromContractWithCustomerExcludingAssessedTax", F.when(every(3), revenue)),
        ("CostOfRevenue", cost),
        ("GrossProfit", F.when(~every(13), gross)),
        ("OperatingExpenses", expenses),
        ("ResearchAndDevelopmentExpense", ct),
        ("SellingGeneralAndAdministrativeExpense", c * 5),
        ("OperatingIncomeLoss", operating),
        ("InterestExpense", interest),
        ("IncomeTaxExpenseBenefit", cd),
        ("NetIncomeLoss", net),
        ("Assets", assets),
        ("AssetsCurrent", col["cq"]),
        ("CashAndCashEquivalentsAtCarryingValue", cd * 2),
        ("AccountsReceivableNetCurrent", col["filled"] * 20),
        ("InventoryNet", F.when(~every(7), col["fresh"] * 20)),
        ("Liabilities", liabilities),
        ("LiabilitiesCurrent", F.when(every(17), F.lit(0)).otherwise(col["accepted"] * 60)),
        ("LongTermDebtNoncurrent", c * 10 + cd),
        ("StockholdersEquity", assets - liabilities - col["returned"] * 60),
        ("NetCashProvidedByUsedInOperatingActivities", net + ct + cd),
        ("NetCashProvidedByUsedInInvestingActivities", -cd),
        ("NetCashProvidedByUsedInFinancingActivities", -ct),
        ("PaymentsToAcquirePropertyPlantAndEquipment", cd),
    ]
    return [(name, "USD", value) for name, value in usd] + [("OtherThing", "shares", col["q"])]


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per company and period: what its facts share, and ``values`` by concept.

    The rows lie by ``cik``; each stands for some 25 reported facts.
    """
    periods = _periods(spark, sf_dir)
    company = companies(spark, sf_dir)
    year, period = F.col("fiscal_year"), F.col("fiscal_period")
    month = F.when(period == "FY", F.lit(12)).otherwise(F.substring(period, 2, 1).cast("int") * 3)
    closing = F.last_day(F.make_date(year, month, F.lit(1)))
    filed = F.date_add("closing", (F.col("s_suppkey") % 20 + 30).cast("int"))
    return (
        # Not by broadcast, which might leave the rows where the companies lie.
        periods.join(company.hint("merge"), "cik")
        .withColumn("closing", closing)
        .select(
            "cik",
            "s_suppkey",
            "company_name",
            F.date_format("closing", "yyyy-MM-dd").alias("end_date"),
            F.concat_ws("-", F.lpad("cik", 10, "0"), year.cast("string"), period).alias("accn"),
            year.cast("int").alias("fiscal_year"),
            "fiscal_period",
            F.when(period.isin("Q4", "FY"), "10-K").otherwise("10-Q").alias("base_form"),
            F.date_format(filed, "yyyy-MM-dd").alias("filed_date"),
            F.date_format(F.date_add(filed, 90), "yyyy-MM-dd").alias("amended_date"),
            F.when(period != "FY", F.concat(F.lit("CY"), year.cast("string"), period)).alias("frame"),
            F.array(*[value.cast("double") for _, _, value in _concepts()]).alias("values"),
        )
    )


# The fields of a fact by their names in a document.
FACT_NAMES = {
    "end_date": "end",
    "value": "val",
    "accession_number": "accn",
    "fiscal_year": "fy",
    "fiscal_period": "fp",
    "form": "form",
    "filed_date": "filed",
    "frame": "frame",
}

# Noise: what every n-th company files once more of a concept.
AMENDED = (*REVENUE_CONCEPTS, "Assets")
COPIES = {
    "-A": (5, AMENDED),
    "-E": (11, ("Assets",)),
    "-S": (6, ("Assets",)),
    "-N": (9, ("Liabilities",)),
    "-Y": (10, ("Liabilities",)),
    "-V": (8, ("InterestExpense",)),
}


def _copies(concept: str) -> list[str]:
    return ["", *[copy for copy, (_, concepts) in COPIES.items() if concept in concepts]]


def _has_copy(copy: str, key: Column) -> Column:
    return key % COPIES[copy][0] == 0 if copy else F.lit(True)


def _unit(copy: str, unit: str) -> str:
    return "EUR" if copy == "-E" else unit


def _fact(report, value: Column, copy: str) -> dict[str, Column]:
    """The fields of a fact; ``report`` gives a column of :func:`_reports` by name."""
    year = {"-Y": F.lit(1800), "-N": F.lit(None).cast("int")}.get(copy)
    return {
        "end_date": report("end_date"),
        "value": {"-A": value + 1_000_000, "-V": F.lit(None).cast("double")}.get(copy, value),
        "accession_number": F.concat(report("accn"), F.lit(copy)) if copy else report("accn"),
        "fiscal_year": report("fiscal_year") if year is None else year,
        "fiscal_period": report("fiscal_period"),
        "form": F.lit("S-1") if copy == "-S" else report("base_form"),
        "filed_date": report("amended_date" if copy == "-A" else "filed_date"),
        "frame": report("frame"),
    }


def reported_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rows as a company would report them, with amended, foreign-unit,
    foreign-form, year-less, wrong-year and value-less copies mixed in."""
    cells = []
    for place, (concept, unit, _) in enumerate(_concepts()):
        value = F.col("values")[place]
        for copy in _copies(concept):
            cell = {"concept": F.lit(concept), "unit": F.lit(_unit(copy, unit)), **_fact(F.col, value, copy)}
            cell = F.struct(*[column.alias(name) for name, column in cell.items()])
            cells.append(F.when(value.isNotNull() & _has_copy(copy, F.col("s_suppkey")), cell))
    return (
        _reports(spark, sf_dir)
        .select("cik", "company_name", F.inline(F.array_compact(F.array(*cells))))
        .select(
            "cik",
            "company_name",
            "concept",
            "unit",
            "end_date",
            "value",
            "accession_number",
            "fiscal_year",
            "fiscal_period",
            "form",
            "filed_date",
            "frame",
        )
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per company: what :func:`nest_documents` makes of :func:`reported_facts`.

    A company's period rows are gathered and its facts are spread inside its one row, so
    no long row is ever sorted or held: what a task sorts are some 25 times fewer rows.
    """
    reports = _reports(spark, sf_dir).drop("company_name")
    gathered = reports.groupBy("cik").agg(
        F.first("s_suppkey").alias("s_suppkey"),
        F.collect_list(F.struct(*[c for c in reports.columns if c not in ("cik", "s_suppkey")])).alias("reports"),
    )

    def facts(place: int, copy: str) -> Column:
        def fact(report: Column) -> Column:
            fields = _fact(report.getField, report["values"][place], copy)
            return F.struct(*[fields[name].alias(short) for name, short in FACT_NAMES.items()])

        reported = F.filter("reports", lambda report: report["values"][place].isNotNull())
        every = F.transform(reported, fact)
        return F.when(_has_copy(copy, F.col("s_suppkey")), every).otherwise(F.slice(every, 1, 0)) if copy else every

    # Each list is named once, since Spark works out an expression as often as it is named.
    bodies = []
    for place, (concept, unit, _) in enumerate(_concepts()):
        by_unit: dict[str, list[Column]] = {}
        for copy in _copies(concept):
            by_unit.setdefault(_unit(copy, unit), []).append(facts(place, copy))
        lists = {u: found[0] if len(found) == 1 else F.concat(*found) for u, found in by_unit.items()}
        units = F.array(*[F.struct(F.lit(u).alias("unit"), found.alias("facts")) for u, found in lists.items()])
        units = F.filter(units, lambda entry: F.size(entry["facts"]) > 0)
        bodies.append(F.struct(F.lit(concept).alias("concept"), units.alias("units")))
    reported = F.filter(F.array(*bodies), lambda entry: F.size(entry["units"]) > 0)
    concepts = F.map_from_entries(
        F.transform(
            reported,
            lambda entry: F.struct(
                entry["concept"].alias("concept"),
                F.struct(F.map_from_entries(entry["units"]).alias("units")).alias("body"),
            ),
        )
    )
    some = F.exists("reports", lambda report: F.exists(report["values"], lambda value: value.isNotNull()))
    # The attributes join before the facts are spread, while a company's row is short.
    joined = gathered.where(some).join(companies(spark, sf_dir).drop("s_suppkey"), "cik")
    return joined.select("cik", _document_text(concepts).alias("doc_json"))


def nest_documents(long: DataFrame, company: DataFrame) -> DataFrame:
    """Long rows to one JSON text per company (the inverse of the parser).

    A company's rows are bounded by concepts x periods x copies, whatever the
    number of line items behind them. The rows of ``reported_facts`` are already
    dealt by company, so none of the three levels shuffles them again.
    """
    fact = F.struct(*[F.col(name).alias(short) for name, short in FACT_NAMES.items()])
    by_unit = long.groupBy("cik", "concept", "unit").agg(F.collect_list(fact).alias("facts"))
    by_concept = by_unit.groupBy("cik", "concept").agg(
        F.struct(F.map_from_entries(F.collect_list(F.struct("unit", "facts"))).alias("units")).alias(
            "body"
        )
    )
    by_company = by_concept.groupBy("cik").agg(
        F.map_from_entries(F.collect_list(F.struct("concept", "body"))).alias("concepts")
    )
    return by_company.join(company, "cik").select("cik", _document_text(F.col("concepts")).alias("doc_json"))


def _document_text(concepts: Column) -> Column:
    """The JSON text of a company's nested ``concepts`` and its attributes."""
    return F.to_json(
        F.struct(
            F.col("cik").cast("long").alias("cik"),
            F.col("company_name").alias("entityName"),
            F.array("ticker").alias("tickers"),
            F.array("exchange").alias("exchanges"),
            F.struct(concepts.alias("us-gaap")).alias("facts"),
        )
    )


def with_broken_copies(documents: DataFrame) -> DataFrame:
    """The documents, and cut-off copies of every seventh one, which no reader can parse.

    Both come from one pass, so the documents are not made a second time.
    """
    half = F.when(
        F.col("cik").cast("long") % 7 == 3, F.expr("substring(doc_json, 1, length(doc_json) DIV 2)")
    )
    copies = F.array_compact(F.array("doc_json", half))
    return documents.withColumn("doc_json", F.explode(copies))


def nest_submissions(company: DataFrame) -> DataFrame:
    """Attribute document per company; every fourth one comes again without its attributes."""
    blank = company.where(F.col("cik").cast("long") % 4 == 1).withColumns(
        {name: F.lit(None).cast("string") for name in ("ticker", "exchange", "sic_code")}
    )
    return company.unionByName(blank).select(
        F.to_json(
            F.struct(
                "cik",
                F.col("company_name").alias("name"),
                F.col("sic_code").alias("sic"),
                F.array("ticker").alias("tickers"),
                F.array("exchange").alias("exchanges"),
            )
        ).alias("doc_json")
    )
