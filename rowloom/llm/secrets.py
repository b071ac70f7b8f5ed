"""Secret scans with a ledger of blobs that were scanned before."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import empty_if_null

# The kinds in order, their patterns, the group that must be long enough, and its least length.
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    ("access", r"AKIA[A-Z0-9]+", 0, 16, False),
    ("hex", r"[0-9a-f]+", 0, 32, False),
)
# A new version of the rules makes every blob unseen again.
RULES_VERSION = "base-1"
_ENTRY = "address string, version string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """Start, end (code points, exclusive) and kind of every secret, by start, then in the order of the kinds.

    Matches are leftmost and do not overlap within a kind; those too short are dropped, but keep
    others from starting inside them.
    """
    found = []
    for rank, (kind, pattern, group, least, either_case) in enumerate(RULES):
        if either_case and not _HINT.search(text):
            continue
        if kind == "hex":
            # Runs are maximal, so looking for long ones finds the same spans.
            pattern = rf"[0-9a-f]{{{least},}}"
        compiled = re.compile(pattern, re.I | re.A if either_case else re.A)
        for match in compiled.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), rank, match.end(), kind))
    return [(start, end, kind) for start, _, end, kind in sorted(found)]


# What every match of the assign kind holds.
_HINT = re.compile(r"[Pp][Aa][Ss][Ss][Ww]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")


def _scan(batches: Iterator[pa.RecordBatch], version: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for address, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = find_secrets(text.as_py())
            spans = ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)
            counts = [sum(1 for f in found if f[2] == rule[0]) for rule in RULES]
            out.append((address, version, *counts, hashlib.sha256(spans.encode()).hexdigest(), spans))
        columns = list(zip(*out, strict=True)) or [()] * 7
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = [c.split()[0] for c in _ENTRY.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's entries: one row per scanned blob address and rule version, with its findings."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
    return spark.read.schema(_ENTRY).parquet(path) if there else spark.createDataFrame([], _ENTRY)


def scan_new(versions: DataFrame, path: str, text: str = "text", version: str = RULES_VERSION) -> int:
    """Scan the blobs among ``versions`` that the ledger at ``path`` does not hold under this rule version.

    A blob is a distinct text (null: empty), addressed by its SHA-256. Texts whose address is known are dropped
    before anything is shuffled that holds text, if the ledger is small enough to broadcast; copies within a task are merged before the
    shuffle. Findings and the fact that a blob was scanned are appended together, in one write, so a
    failed run leaves nothing half recorded and may simply be repeated. Returns the number of blobs scanned.
    """
    spark = versions.sparkSession
    whole = empty_if_null(F.col(text))
    known = ledger(spark, path).where(F.col("version") == version).select("address")
    before = known.count()
    blobs = versions.select(F.sha2(whole, 256).alias("address"), whole.alias("text"))
    if before:
        blobs = blobs.join(known, "address", "left_anti")
    blobs.distinct().mapInArrow(lambda batches: _scan(batches, version), _ENTRY).write.mode("append").parquet(path)
    return ledger(spark, path).where(F.col("version") == version).count() - before


def findings(versions: DataFrame, path: str, keep: list[str], text: str = "text", version: str = RULES_VERSION) -> DataFrame:
    """The ledger's findings joined back to every row of ``versions``: the columns ``keep``, then address and findings.

    Rows of one blob, its paths and historical versions, all get its findings; repeated rows come
    back one by one. Rows whose blob was not scanned under this rule version are left out.
    """
    entries = ledger(versions.sparkSession, path).where(F.col("version") == version).drop("version")
    paths = versions.select(*[F.col(f"`{c}`") for c in keep], F.sha2(empty_if_null(F.col(text)), 256).alias("address"))
    renamed = entries.select(F.col("address").alias("__address"), *[F.col(c).alias(f"__{c}") for c in entries.columns if c != "address"])
    joined = paths.join(renamed, paths["address"] == F.col("__address")).drop("__address")
    return joined.withColumnsRenamed({f"__{c}": c for c in entries.columns})
