"""Stored layers of one data directory, built on first use.

The layers are written once per application to shared storage and every query
reads them from there, as it would in production. Stored tables also cut the
lineage: an executor lost later costs a re-read, not a rebuild.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.operators.bronze import extract_submission_info
from ledgerstrata.plans import medallion
from ledgerstrata.sources import read_documents, read_submissions, read_table, valid_documents
from ledgerstrata.storage import shared_root
from ledgerstrata.testbed import filings

BULK_YEAR = 2024
_LOCK = threading.RLock()
_OPEN: dict[tuple[str, str], "Workspace"] = {}


class Workspace:
    """Landing files and tables derived from one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        self.spark, self.sf_dir, self.root = spark, sf_dir, root
        self.facts_path = f"{root}/landing/companyfacts/bulk/{BULK_YEAR}"
        self.submissions_path = f"{root}/landing/submissions/bulk/{BULK_YEAR}"
        self.tag = root.rsplit("/", 1)[-1]
        self.archive_path = f"{root}/landing/archives"
        self._built: set[str] = set()

    def _once(self, step: str, build) -> None:
        with _LOCK:
            if step not in self._built:
                build()
                self._built.add(step)

    # --- landing -----------------------------------------------------------

    def _land(self) -> None:
        company = filings.companies(self.spark, self.sf_dir)
        docs = filings.with_broken_copies(filings.documents(self.spark, self.sf_dir)).select("doc_json")
        # One document is one line and a file one task's documents, so that a packed
        # file is read as well side by side as a plain one.
        with medallion.shuffles_removed(self.spark):
            docs.write.mode("overwrite").text(self.facts_path, compression="gzip")
        submissions = filings.nest_submissions(company)
        submissions.write.mode("overwrite").text(self.submissions_path, compression="gzip")

    def _pack(self) -> None:
        """The documents again as zip archives, one per input partition that has any,
        next to an archive without members and one that is cut off."""
        target = self.archive_path

        def pack(batches):
            import io
            import re
            import uuid
            import zipfile

            import pandas as pd
            from pyarrow import fs
            from pyspark import TaskContext

            filesystem, folder = fs.FileSystem.from_uri(target)
            filesystem.create_dir(folder, recursive=True)
            partition = TaskContext.get().partitionId()

            def put(name: str, data: bytes) -> None:
                # A retried task replaces the archive of the lost one.
                scratch = f"{folder}/.{uuid.uuid4().hex}"
                with filesystem.open_output_stream(scratch) as out:
                    out.write(data)
                filesystem.move(scratch, f"{folder}/{name}")

            count, buffer = 0, io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                for batch in batches:
                    for text in batch["value"]:
                        cik = int(re.match(r'{"cik":(\d+)', text).group(1))
                        archive.writestr(f"CIK{cik:010d}-{count}.json", text)
                        count += 1
            if partition == 0:
                empty = io.BytesIO()
                zipfile.ZipFile(empty, "w").close()
                put("empty.zip", empty.getvalue())
                put("damaged.zip", buffer.getvalue()[: buffer.tell() // 2])
            if count:
                put(f"docs-{partition:05d}.zip", buffer.getvalue())
            yield pd.DataFrame({"members": [count]})

        lines = self.spark.read.text(self.documents_folder())
        lines.mapInPandas(pack, "members long").agg(F.sum("members")).first()

    def _index(self) -> None:
        """A form index per filing day, one line per filing, in the daily-index layout."""
        target = f"{self.root}/landing"

        def write(day):
            import pandas as pd
            from pyarrow import fs

            date = day["filing_date"].iloc[0]
            filesystem, folder = fs.FileSystem.from_uri(target)
            folder = f"{folder}/daily-index/{date:%Y/%m/%d}"
            filesystem.create_dir(folder, recursive=True)
            lines = sorted(f"{cik}|{number}\n" for cik, number in zip(day["cik"], day["accession_number"]))
            # A retried task writes the same bytes again.
            with filesystem.open_output_stream(f"{folder}/form.idx") as out:
                out.write("".join(lines).encode())
            return pd.DataFrame({"lines": [len(lines)]})

        filings = self.table("fact_submissions").where("filing_date IS NOT NULL")
        days = filings.select("filing_date", "cik", "accession_number").groupBy("filing_date")
        days.applyInPandas(write, "lines long").agg(F.sum("lines")).first()

    def daily_index_folder(self) -> str:
        self._once("daily-index", self._index)
        return f"{self.root}/landing"

    def documents_folder(self) -> str:
        self._once("landing", self._land)
        return self.facts_path

    def archives_folder(self) -> str:
        self._once("archives", self._pack)
        return self.archive_path

    def landed_documents(self) -> DataFrame:
        """All documents, with those that cannot be parsed."""
        return read_documents(self.spark, self.documents_folder())

    def documents(self) -> DataFrame:
        return valid_documents(self.landed_documents())

    def submissions(self) -> DataFrame:
        self._once("landing", self._land)
        return read_submissions(self.spark, self.submissions_path)

    # --- layers ------------------------------------------------------------

    def _bronze(self) -> None:
        medallion.build_bronze(self.spark, self.landed_documents(), self.root)

    def _silver(self) -> None:
        self._once("bronze", self._bronze)
        medallion.build_silver(
            self.spark,
            self.root,
            submission_info=extract_submission_info(self.submissions()),
            sic_map=filings.sic_map(self.spark, self.sf_dir),
        )

    def _gold(self) -> None:
        self._once("silver", self._silver)
        medallion.build_gold(self.spark, self.root)

    def layer(self, layer: str) -> None:
        """Make sure a layer and those below it are stored."""
        self._once(layer, {"bronze": self._bronze, "silver": self._silver, "gold": self._gold}[layer])

    def table(self, name: str) -> DataFrame:
        from ledgerstrata.schemas import TABLES

        self.layer(TABLES[name][0])
        return read_table(self.spark, self.root, name)


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of a data directory in the running application."""
    sf_dir = str(sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _OPEN:
            tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
            _OPEN[key] = Workspace(spark, sf_dir, f"{shared_root(spark)}/{key[0]}/{tag}")
        return _OPEN[key]
