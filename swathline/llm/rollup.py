"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are additive, so a change of the corpus is a set of signed rows: an
insert adds a document's count, a delete takes it away, a revision takes away the old count and adds the new one.  A batch of
changes is first summed by group (with map-side combining, so a hot source costs one row a task) and then committed as
one folder; its success marker is the commit.  A batch that was committed before is left alone, and one that was cut
off is written anew, so that replays change nothing.  Totals are the sum of the committed folders, which ``compact`` can replace by
one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .textkit import WORD, released, shared_folder
from .tokenstore import encoder

GROUP = ("source", "lang", "version")
#: Versions of ``measured``: patterns whose matches are the tokens.
VERSIONS = {
    "words-1": WORD,
    "pieces-1": r"[0-9A-Za-z]+|[^\x00-\x20\x7F0-9A-Za-z]",
}


def _tokens(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def measured(docs: DataFrame, versions: dict[str, str] | None = None, redacting: str | None = None) -> DataFrame:
    """``(doc_id, source, lang, version, tokens)`` for each row and version; a null text has no tokens.

    With ``redacting``, a pattern, a column ``redacted`` as well: the tokens of the text without what the pattern matches.
    Both are counted where the text is read, so what chooses the documents to redact is joined with counts alone.
    """
    versions, text = VERSIONS if versions is None else versions, F.col("text")
    counts = []
    for name, pattern in versions.items():
        fields = [F.lit(name).alias("version"), _tokens(text, pattern).alias("tokens")]
        if redacting:
            less = F.when(text.rlike(redacting), _tokens(F.regexp_replace(text, redacting, ""), pattern)).otherwise(fields[1])
            fields.append(less.alias("redacted"))
        counts.append(F.struct(*fields))
    return docs.select("doc_id", "source", "lang", F.explode(F.array(*counts)).alias("c")).select("doc_id", "source", "lang", "c.*")


def token_counts(docs: DataFrame, tokenizers: dict[str, str], redacting: str | None = None) -> DataFrame:
    """``measured`` by tokenizers: ``tokenizers`` names the file of each version (see ``tokenstore.Encoder``).

    One pass over the texts serves all versions.  A null text has no tokens; repeated rows and null ids are counted each;
    an empty table gives an empty one.  ``redacting`` is a pattern in RE2 syntax.
    """

    def count(column: pa.Array, path: str) -> np.ndarray:
        parts = [np.diff(lists.offsets.to_numpy()).astype(np.int64) - 1 for _, lists in released(encoder(path).encode(column))]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            text = batch.column(3).cast(pa.string())
            if redacting:
                places = np.flatnonzero(pc.match_substring_regex(text, redacting).fill_null(False).to_numpy(zero_copy_only=False))
                less = pc.replace_substring_regex(text.take(pa.array(places)), redacting, "")
            for name, path in tokenizers.items():
                counts = count(text, path)
                columns = [*batch.columns[:3], pa.array([name] * len(text)), pa.array(counts)]
                if redacting:
                    redacted = counts.copy()
                    redacted[places] = count(less, path)
                    columns.append(pa.array(redacted))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", *GROUP, "tokens", *(["redacted"] if redacting else [])]
    rows = docs.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, source string, lang string, version string, tokens long" + (", redacted long" if redacting else ""))


def inserts(rows: DataFrame) -> DataFrame:
    """Signed rows that add counts ``(source, lang, version, tokens)``; each row is a document, repeated ones and nulls included."""
    return rows.select(*GROUP, F.lit(1).cast("long").alias("docs"), "tokens")


def deletes(rows: DataFrame) -> DataFrame:
    """Signed rows that take counts away; those of a document that was never added leave a negative total behind."""
    return rows.select(*GROUP, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts that replace counts of the same documents, which may change their group as well; either side may be empty."""
    return deletes(old).union(inserts(new))


class Rollup:
    """Additive totals under a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}"

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _held(self) -> DataFrame | None:
        """The names of the batches that a compacted rollup's totals stand for."""
        return self.spark.read.parquet(f"{self.folder}/held") if self._files().exists(self._path("held", "_SUCCESS")) else None

    def committed(self, batch: str) -> bool:
        """Whether the batch was committed here, or to a rollup that this one was compacted from."""
        if self._files().exists(self._path(f"batch={batch}", "_SUCCESS")):
            return True
        held = self._held()
        return held is not None and not held.where(F.col("batch") == batch).isEmpty()

    def batches(self) -> list[str]:
        files = self._files()
        if not files.exists(self._path()):
            return []
        names = (s.getPath().getName() for s in files.listStatus(self._path()))
        return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch=") and files.exists(self._path(n, "_SUCCESS")))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed ``changes(source, lang, version, docs, tokens)``; False if it was committed before."""
        if self.committed(batch):
            return False
        summed = changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        summed.write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """``(source, lang, version, n_docs, n_tokens)`` over all committed batches; groups without documents are left out.

        Nulls of a group are a value of their own.
        """
        found = [f"{self.folder}/batch={b}" for b in self.batches()]
        if not found:
            return self.spark.createDataFrame([], "source string, lang string, version string, n_docs long, n_tokens long")
        # one scan of all folders
        sums = self.spark.read.schema("source string, lang string, version string, docs long, tokens long").parquet(*found).groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self, name: str) -> Rollup:
        """A rollup in a new folder that holds the totals as its one batch, and the names of the batches they are made of."""
        other, names = Rollup(self.spark), self.spark.createDataFrame([(b,) for b in self.batches()], "batch string")
        held = self._held()
        (names if held is None else names.union(held)).write.parquet(f"{other.folder}/held")
        totals = self.totals().select(*GROUP, F.col("n_docs").alias("docs"), F.col("n_tokens").alias("tokens"))
        totals.coalesce(1).write.parquet(f"{other.folder}/batch={name}")
        return other
