"""Frequency of every distinct term, kept up to date by signed deltas.

The store holds, for each role and term, how often the term occurs and how many records hold it. It is a
folder of parquet parts: terms are hashed into buckets, each bucket has one current version, and a small
manifest names the current version of every bucket. A change of the collection is turned into signed
rows - the new form of a record counts +1, its old form -1, unchanged records not at all - which are summed
per term before they are shuffled and merged into the buckets they touch. Counts of the whole collection
are never recomputed; the first load is the delta against an empty store."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Outer white space, as Unicode has it, with the separators U+001C to U+001F.
BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: A role that no term list has: its row counts the records themselves.
ALL_RECORDS = "*"
STORED = T.StructType(
    [
        T.StructField("role", T.StringType(), False),
        T.StructField("term", T.StringType(), False),
        T.StructField("occurrences", T.LongType(), False),
        T.StructField("records", T.LongType(), False),
    ]
)


def _terms_of(terms: Column, role: str) -> Column:
    """[(role, term, first)] of an array of strings: stripped, nulls and blanks left out; first is 1 for
    one occurrence of each distinct term, 0 for its repetitions."""
    clean = F.filter(F.transform(F.coalesce(terms, F.array().cast("array<string>")), lambda t: F.regexp_replace(t, BLANKS, "")), lambda t: t != "")
    ordered = F.array_sort(clean)
    return F.transform(
        ordered,
        lambda t, i: F.struct(
            F.lit(role).alias("role"),
            t.alias("term"),
            F.when((i == 0) | (F.get(ordered, i - 1) != t), 1).otherwise(0).cast("long").alias("first"),
        ),
    )


def signed_rows(df: DataFrame, roles: dict[str, Column], sign: int) -> DataFrame:
    """(role, term, occurrences, records) of every record, as changes of the given sign, summed per term; a column `_times`
    says how many records a row stands for.

    `roles` gives the array of terms of each role. A record with null or empty lists still counts as a
    record. The sums are taken before the shuffle, so a term in a third of all rows costs one row a task."""
    records = F.array(F.struct(F.lit(ALL_RECORDS).alias("role"), F.lit("").alias("term"), F.lit(1).cast("long").alias("first")))
    entries = F.concat(records, *[_terms_of(terms, role) for role, terms in roles.items()])
    times = F.col("_times") if "_times" in df.columns else F.lit(1).cast("bigint")
    one = df.select(F.explode(entries).alias("e"), times.alias("t")).select("e.role", "e.term", "e.first", "t")
    return one.groupBy("role", "term").agg((F.sum("t") * sign).alias("occurrences"), (F.sum(F.col("first") * F.col("t")) * sign).alias("records"))


def changes(old: DataFrame, new: DataFrame, key: str, watched: list[str]) -> DataFrame:
    """(watched..., _times): the forms of records by which `new` differs from `old`, with how many times more often they
    stand in `new`, below 0 for those that went; what stands equally often in both is not in it.

    A form is the key with a digest of the watched columns; null keys count as one key. Rows are counted per form on both sides before they
    meet, so repeated rows and a key that holds any share of the rows cost one row a form, and every repetition counts."""
    digest = F.sha2(F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(watched)]), {"ignoreNullFields": "false"}), 256)
    both = [d.select(F.struct(F.col(key).alias("k"), digest.alias("d")).alias("_form"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(watched)], F.lit(sign).cast("bigint").alias("_sign")) for d, sign in ((old, -1), (new, 1))]
    shape = F.struct(*[F.col(f"_c{i}") for i in range(len(watched))])
    # rows of a form are alike, so any of them stands for it
    moved = both[0].unionByName(both[1]).groupBy("_form").agg(F.sum("_sign").alias("_times"), F.any_value(shape).alias("_row")).where("_times <> 0")
    return moved.select(*[F.col(f"_row._c{i}").alias(c) for i, c in enumerate(watched)], "_times")


class ConcurrentChange(RuntimeError):
    """Two changes started from the same state; the later one is not published."""


class TermStore:
    """The persistent counts in a folder."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _fs(self):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _latest(self) -> int:
        """The number of the last published manifest, -1 if there is none."""
        jvm, fs = self._fs()
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        if not fs.exists(at):
            return -1
        found = [str(s.getPath().getName()) for s in fs.listStatus(at)]
        return max((int(n[9:-5]) for n in found if n.startswith("manifest-") and n.endswith(".json")), default=-1)

    def _manifest(self) -> dict:
        number = self._latest()
        if number < 0:
            return {"version": -1, "buckets": self.buckets, "current": {}}
        path = f"{self.path}/manifest-{number:012d}.json"
        return json.loads("".join(r.value for r in self.spark.read.text(path, wholetext=True).collect()))

    def _publish(self, manifest: dict) -> None:
        """The next manifest, under the next number: written aside and renamed, which fails if someone else has published
        that number. Readers always find the last one whole, and the one before it stays for those who have read it."""
        jvm, fs = self._fs()
        path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        manifest["version"] += 1
        fresh, place = path(f"_fresh-{uuid.uuid4().hex}"), path(f"manifest-{manifest['version']:012d}.json")
        out = fs.create(fresh, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if fs.exists(place) or not fs.rename(fresh, place):
            fs.delete(fresh, False)
            raise ConcurrentChange(f"{self.path} was changed at the same time; apply the change again")

    def vacuum(self) -> None:
        """Delete old manifests and what only they name. Not for use beside readers of older states."""
        jvm, fs = self._fs()
        manifest = self._manifest()
        kept = {part.split("/")[0] for part in manifest["current"].values()} | {f"manifest-{manifest['version']:012d}.json"}
        for status in fs.listStatus(jvm.org.apache.hadoop.fs.Path(self.path)):
            if str(status.getPath().getName()) not in kept:
                fs.delete(status.getPath(), True)

    def counts(self) -> DataFrame:
        """(role, term, occurrences, records) as they stand, with the row that counts records under role *."""
        paths = [f"{self.path}/{part}" for part in self._manifest()["current"].values()]
        if not paths:
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).parquet(*paths)

    def merge(self, delta: DataFrame) -> None:
        """Add signed rows to the counts. Only buckets that a change falls into are written anew; a term
        whose counts come to nothing is dropped."""
        manifest = self._manifest()
        n = manifest["buckets"]
        bucket = F.pmod(F.xxhash64("role", "term"), F.lit(n)).cast("int")
        version = uuid.uuid4().hex
        current = manifest["current"]
        moved = delta.select("role", "term", "occurrences", "records")
        if current:
            from ..session import cut

            moved = cut(moved, "term-delta")
            touched = {str(r.b) for r in moved.select(bucket.alias("b")).distinct().collect()}
            kept = [f"{self.path}/{part}" for b, part in current.items() if b in touched]
            if kept:
                moved = moved.unionByName(self.spark.read.schema(STORED).parquet(*kept))
        merged = moved.groupBy("role", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
        merged = merged.where("occurrences <> 0 or records <> 0").withColumn("bucket", bucket)
        # one task, and so one file, a bucket; they are as many as were made when the store was
        merged.repartition(n, "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{version}")
        jvm, fs = self._fs()
        written = {s.getPath().getName() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{version}"))}
        fresh = {name.split("=")[1]: f"{version}/{name}" for name in written if name.startswith("bucket=")}
        if current:
            current = {b: part for b, part in current.items() if b not in touched}
        manifest["current"] = current | fresh
        self._publish(manifest)

    def apply(self, old: DataFrame | None, new: DataFrame | None, key: str, watched: list[str], roles) -> None:
        """Bring the counts from the collection `old` to the collection `new` (None: empty). `roles` maps
        a frame to the term arrays by role."""
        if old is not None and new is not None:
            moved = changes(old, new, key, watched)
            self.merge(signed_rows(moved, roles(moved), 1))
            return
        for df, sign in ((old, -1), (new, 1)):
            if df is not None:
                self.merge(signed_rows(df, roles(df), sign))


def marks(counts: DataFrame, rare_below: int = 3, common_share: float = 0.05) -> DataFrame:
    """(role, term, occurrences, records, mark): mark is `rare` for terms in fewer than `rare_below`
    records, `common` for those in more than `common_share` of all records, else null. A term that is both,
    as can be in a tiny collection, is `rare`."""
    total = counts.where(F.col("role") == ALL_RECORDS).agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n_records"))
    terms = counts.where(F.col("role") != ALL_RECORDS)
    n = total.collect()[0].n_records  # one number
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") > F.lit(common_share) * F.lit(n), "common")
    return terms.withColumn("mark", mark)


def svc_roles(df: DataFrame) -> dict[str, Column]:
    """The S, V and C lists of `svc_keywords`, over all sentences of a row."""
    lists = F.coalesce(F.map_values("svc_keywords"), F.array().cast("array<struct<s:array<string>,v:array<string>,c:array<string>>>"))
    empty = F.array().cast("array<string>")

    def of(role: str) -> Column:
        return F.flatten(F.transform(lists, lambda x: F.coalesce(x[role], empty)))

    return {role: of(role) for role in ("s", "v", "c")}
