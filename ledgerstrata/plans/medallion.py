"""The batch run: documents -> bronze -> silver -> gold, each layer stored.

Every step reads stored tables and writes stored tables, so a failed run
resumes at a layer and nothing is held in memory between steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from math import ceil

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.operators import bronze, dimensions, facts, gold, quality
from ledgerstrata.schemas import TABLES
from ledgerstrata.sinks import catalog
from ledgerstrata.sinks.tables import CODEC, RANGE_BYTES, by_range, refresh_view, save, stored_bytes, touched_years
from ledgerstrata.sources.documents import CORRUPT, rejected_documents
from ledgerstrata.sources.tables import read_table, table_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes that a task sorts per stored byte of packed unchecked rows, at the least.
PACKED = 16
# Stored bytes of documents, some 500,000 of their rows, that a task unnests and sorts in memory.
TASK_BYTES = 4 << 20
# Unpacked bytes of a row group of documents, which is what tasks can be cut into.
GROUP_BYTES = 4 << 20

# Ratios and the time series read the metrics, peers read the ratios.
GOLD_ORDER = ("company_metrics", "financial_ratios", "peer_comparison", "timeseries")


def _together(spark: SparkSession, *writes: Callable[[], object]) -> None:
    """Submit independent writes at once, so that the tail of one job leaves no
    executor idle. The first failure is raised after all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in running:
        write.result()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, object]):
    """Settings of the session that return afterwards to what they were."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _task_bytes(spark: SparkSession, size: int):
    """Let tasks read about ``size`` bytes of files or of a rebalance, or less where the
    session says so."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    return _settings(spark, {name: min(size, _bytes(spark.conf.get(name))) for name in names})


def shuffles_removed(spark: SparkSession):
    """Let every write drop its shuffle files when it ends, not when the driver happens
    to collect its garbage: nothing reads the frame of a stored layer a second time."""
    return _settings(spark, {CLEANUP: True})


def _bytes(setting: str) -> int:
    """A size as Spark writes it, such as ``67108864b``, ``64MB`` or ``1m``."""
    digits = setting.strip().lower().rstrip("b")
    power = "kmgtp".find(digits[-1:]) + 1 if digits[-1:].isalpha() else 0
    return int(digits[:-1] if power else digits) << (10 * power)


def build_bronze(spark: SparkSession, documents: DataFrame, root: str, **options) -> dict[str, int]:
    """Write both bronze tables; returns row and passed counts observed on the way.

    The documents are read, unzipped and parsed once: they land as Parquet under
    ``{root}/landing/documents``, from where both tables and the rejected
    documents (``{root}/bronze/rejected_documents``) are taken.

    The unchecked rows are not shuffled: a task unnests a bounded share of the documents,
    sorts its rows by year bucket and writes one file per bucket.
    """
    landed = f"{root}/landing/documents"
    writer = documents.write.mode("overwrite").option("compression", CODEC)
    writer.option("parquet.block.size", GROUP_BYTES).parquet(landed)
    documents = spark.read.schema(documents.schema).parquet(landed)
    observation = Observation("bronze_quality")
    rows = bronze.extract_financials(documents, **options)
    rows = bronze.observe_quality(rows, observation)
    companies = bronze.extract_companies(documents)
    if CORRUPT in documents.columns:
        rejected_documents(documents).write.mode("overwrite").option("compression", CODEC).parquet(
            f"{root}/bronze/rejected_documents"
        )
    with shuffles_removed(spark), _task_bytes(spark, TASK_BYTES):
        _together(
            spark,
            lambda: save(rows, root, "raw_financials", placed=True),
            lambda: save(companies, root, "raw_companies"),
        )
    return observation.get


def build_dimensions(
    spark: SparkSession,
    root: str,
    *,
    submission_info: DataFrame | None = None,
    sic_map: DataFrame | None = None,
) -> None:
    financials = facts.passed_only(read_table(spark, root, "raw_financials"))
    companies = dimensions.build_dim_companies(
        read_table(spark, root, "raw_companies"), financials, submission_info, sic_map
    )
    taxonomy = dimensions.build_dim_taxonomy(financials)
    dates = dimensions.build_dim_dates(financials)
    _together(
        spark,
        lambda: save(companies, root, "dim_companies"),
        lambda: save(taxonomy, root, "dim_taxonomy"),
        lambda: save(dates, root, "dim_dates"),
    )


def build_facts(spark: SparkSession, root: str) -> None:
    raw = read_table(spark, root, "raw_financials")
    size = PACKED * stored_bytes(spark, table_path(root, "raw_financials"))

    def ranges(name: str) -> bool | int:
        asked, wanted = by_range(name, size, spark), ceil(size / RANGE_BYTES)
        few = int(spark.conf.get("spark.sql.shuffle.partitions")) < facts.TASKS_PER_RANGE * wanted
        # As many ranges as shuffle partitions would each hold more than a task sorts in memory.
        return wanted if asked is True and few else asked

    financials = facts.build_fact_financials(raw, ranges=ranges("fact_financials"))
    submissions = facts.build_fact_submissions(raw, ranges=ranges("fact_submissions"))
    _together(
        spark,
        lambda: save(financials, root, "fact_financials", placed=True),
        lambda: save(submissions, root, "fact_submissions", placed=True),
    )


def build_silver(spark: SparkSession, root: str, **enrichment: DataFrame | None) -> None:
    """Dimensions and facts side by side: both need bronze only."""
    with shuffles_removed(spark):
        _together(
            spark,
            lambda: build_facts(spark, root),
            lambda: build_dimensions(spark, root, **enrichment),
        )


def gold_frame(
    spark: SparkSession, root: str, name: str, read: Callable[[str], DataFrame] | None = None
) -> DataFrame:
    """The defining frame of a gold table over the stored tables it reads.

    ``read`` gives a table by name, by default the one stored under ``root``.
    """
    read = read or (lambda table: read_table(spark, root, table))
    if name == "company_metrics":
        return gold.company_metrics(read("fact_financials"), read("dim_companies"))
    if name == "financial_ratios":
        return gold.financial_ratios(read("company_metrics"))
    if name == "peer_comparison":
        return gold.peer_comparison(read("financial_ratios"))
    return gold.timeseries(read("company_metrics"))


def build_gold(
    spark: SparkSession, root: str, *, years: Iterable[int] | None = None
) -> list[DataFrame]:
    """Refresh the gold tables in dependency order, all years or the given ones."""
    reports: dict[str, DataFrame] = {}
    size = stored_bytes(spark, table_path(root, "fact_financials"))

    def refresh(*names: str) -> None:
        for name in names:
            reports[name] = refresh_view(
                spark, gold_frame(spark, root, name), root, name, years=years, input_bytes=size
            )

    with shuffles_removed(spark):
        refresh("company_metrics")
        _together(
            spark,
            lambda: refresh("financial_ratios", "peer_comparison"),
            lambda: refresh("timeseries"),
        )
    return [reports[name] for name in GOLD_ORDER]


def refresh_touched(spark: SparkSession, root: str, new_facts: DataFrame) -> list[DataFrame]:
    """Refresh only the fiscal years that a batch of facts changes.

    The years are collected; the year check bounds their number.
    """
    years = [row.fiscal_year for row in touched_years(new_facts).collect()]
    return build_gold(spark, root, years=years) if years else []


# --- published tables ----------------------------------------------------------


def publish(spark: SparkSession, root: str, database: str) -> None:
    """Enter every declared table under ``root`` in the catalog, see ``sinks.catalog``."""
    for name in TABLES:
        catalog.publish_table(spark, root, name, database)


def upsert_published(spark: SparkSession, root: str, database: str, batch: DataFrame) -> list[int]:
    """Take late filings into the published facts; returns the fiscal years that changed.

    ``batch`` are rows of ``raw_financials`` that have been appended to that table.
    Stored facts and unchecked rows are read of the touched years only.
    """
    passed = facts.passed_only(batch)
    years = sorted(row.fiscal_year for row in touched_years(passed).collect())
    if not years:
        return years
    raw = read_table(spark, root, "raw_financials", years=(years[0], years[-1]))
    stored = catalog.read_published(spark, database, "fact_financials")
    frame = facts.upsert_facts(
        stored.where(F.col("fiscal_year").isin(years)), raw.where(F.col("fiscal_year").isin(years)), batch
    )
    catalog.switch_years(spark, frame, root, "fact_financials", database, years)
    return years


def refresh_published(
    spark: SparkSession, root: str, database: str, new_facts: DataFrame
) -> list[DataFrame]:
    """Switch the gold years that a batch of facts changes; one report per view.

    A view that fails keeps what it had, and so do those computed from it; their
    reports say so and give what is still published. Of the time series only years in
    which a row changes are written.
    """
    changed = new_facts.where("fiscal_year IS NOT NULL").select("cik", "fiscal_year").distinct()
    years = [row.fiscal_year for row in touched_years(new_facts).collect()]
    if not years:
        return []

    def read(name: str) -> DataFrame:
        return catalog.read_published(spark, database, name)

    reports, failures = [], {}
    for name in GOLD_ORDER:
        try:
            source = {"company_metrics": None, "peer_comparison": "financial_ratios"}.get(name, "company_metrics")
            if source in failures:
                raise failures[source]
            if name == "timeseries":
                metrics = read("company_metrics")
                some = [row.fiscal_year for row in gold.changed_series_years(metrics, changed).collect()]
                frame = gold.timeseries_of_years(metrics, some)
            else:
                some, frame = years, gold_frame(spark, root, name, read)
            reports.append(catalog.switch_years(spark, frame, root, name, database, some))
        except (PySparkException, Py4JJavaError) as error:
            failures[name] = error
            reports.append(catalog.failed_report(spark, database, name, error))
    return reports


def run(
    spark: SparkSession,
    documents: DataFrame,
    root: str,
    *,
    submission_info: DataFrame | None = None,
    sic_map: DataFrame | None = None,
    checks: dict | None = None,
) -> list[DataFrame]:
    """The whole batch: bronze, silver, checks (which stop the run), gold."""
    build_bronze(spark, documents, root)
    build_silver(spark, root, submission_info=submission_info, sic_map=sic_map)
    suite = quality.warehouse_checks() if checks is None else checks
    if suite:
        quality.require(
            quality.run_suite({name: read_table(spark, root, name) for name in suite}, suite)
        )
    return build_gold(spark, root)
