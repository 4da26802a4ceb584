"""Token totals kept up by signed deltas, with idempotent batch commits.

A change holds the counts of a document before and after it: an insert has no
before, a delete no after, a revision both, also when the tokenizer version
changes. Signed rows add up per source, language and tokenizer version. A commit
adds the delta of one batch to the totals of the version before and writes them
as a version of its own; a version counts once its success marker is there.
Committing a batch again changes nothing, and a commit that failed half-way
leaves the totals as they were, to be committed anew.

Rows: NULL keys are keys of their own, a NULL count is 0, a change without
before and after does nothing. Groups whose documents and tokens are all taken
back leave the totals. An empty batch commits unchanged totals; before the first
commit there are none. Columns besides the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
TOTALS = "source STRING, lang STRING, tokenizer STRING, docs BIGINT, tokens BIGINT"
BLANKS = r" \t\n\x0B\f\r"

#: Versions of the counters: words between blanks, words of letters, words and single signs.
COUNTERS = {
    "words-1": rf"[^{BLANKS}]+",
    "words-2": r"\p{L}+",
    "pieces-1": rf"[A-Za-z]+|[0-9]+|[^A-Za-z0-9{BLANKS}]",
}


def count_tokens(text: Column, tokenizer: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(COUNTERS[tokenizer])), F.lit(0)).cast("bigint")


def image(source: Column, lang: Column, tokenizer: str, n_tokens: Column) -> Column:
    """The counts of a document under one tokenizer version, as a change's before or after."""
    return F.struct(
        source.alias("source"), lang.alias("lang"), F.lit(tokenizer).alias("tokenizer"),
        n_tokens.cast("bigint").alias("n_tokens"),
    )


def delta(changes: DataFrame) -> DataFrame:
    """Signed totals of a batch of changes (``before``, ``after``), combined before the shuffle."""
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("before").alias("of")),
        F.struct(F.lit(1).alias("sign"), F.col("after").alias("of")),
    )
    signed = changes.select(F.explode(sides).alias("side")).filter("side.of IS NOT NULL")
    return signed.groupBy(*(F.col(f"side.of.{key}").cast("string").alias(key) for key in KEYS)).agg(
        F.sum("side.sign").cast("bigint").alias("docs"),
        F.sum(F.col("side.sign") * F.coalesce("side.of.n_tokens", F.lit(0))).cast("bigint").alias("tokens"),
    )


class TokenRollup:
    """Totals in one folder, a version for each committed batch. One writer at a time.

    A version's folder names its batch, and Spark's success marker commits both at
    once. So a batch counts once, whenever it comes: late ones are added, and ones
    that arrive again are not.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, version: int, batch: int) -> str:
        return f"{self.folder}/version={version:012d}.batch={batch}"

    def commits(self) -> dict[int, int]:
        """The batch of every version."""
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/version=*/_SUCCESS")
        store = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [status.getPath().getParent().getName() for status in store.globStatus(top) or []]
        pairs = (name.removeprefix("version=").split(".batch=") for name in names)
        return {int(version): int(batch) for version, batch in pairs}

    def version(self) -> int | None:
        """The newest version."""
        return max(self.commits(), default=None)

    def totals(self, version: int | None = None) -> DataFrame:
        commits = self.commits()
        version = max(commits, default=None) if version is None else version
        if version is None:
            return self.spark.createDataFrame([], TOTALS)
        return self.spark.read.schema(TOTALS).parquet(self._path(version, commits[version]))

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Add a batch; False if it was committed before."""
        commits = self.commits()
        if batch in commits.values():
            return False
        last = max(commits, default=0)
        added = self.totals(last or None).unionByName(delta(changes)).groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        added.filter("docs <> 0 OR tokens <> 0").write.mode("overwrite").parquet(self._path(last + 1, batch))
        return True
