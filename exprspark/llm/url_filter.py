"""URL filter by a sorted digest array.

The rules (host suffix and path prefix, written ``host/path``) become one file: sorted 64-bit xxhash keys, and the full rule
strings behind them. Spark hands the file to every executor, where tasks map it into memory. A URL's possible rules
are its host's suffixes at label borders, each with the path prefixes of the lengths that rules have; Spark makes these
and their hashes, tasks probe the array with one vectorised binary search per batch, and a hit counts only if the full
strings agree. The longest rule wins; where two are as long, the one with the longer host.

The index is bounded by ``MAX_RULES``; a longer list is joined by key instead, with the same rows.

Defined results: a null url, and one without ``://``, has empty host and path, fits no rule and is allowed; an empty host
fits no rule; a null rule is dropped, of equal rules ``block`` wins; repeated rows are judged alike; without rules all is
allowed; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from exprspark.llm.common import LOWER, UPPER, let
from exprspark.session import shared_dir

MAX_RULES = 200_000
ALLOW, BLOCK = "allow", "block"
SEED = 42  # of Spark's xxhash64


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty where there is none."""
    u = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(u, r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(u, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def candidates(host: Column, path: Column, lengths: list[int], labels: int) -> Column:
    """All rule strings that would fit, longest host first, then longest path.

    ``lengths`` are those of the rules' paths, ``labels`` the most labels that a rule's host has: longer suffixes fit none.
    """

    def of(every: Column) -> Column:
        n = max(labels, 1)  # without rules there are no labels, but a host has one
        return let(F.slice(every, F.greatest(F.size(every) - n + 1, F.lit(1)), F.lit(n)), ending)

    def ending(last: Column) -> Column:
        suffixes = F.transform(F.sequence(F.lit(1), F.size(last)), lambda i: F.array_join(F.slice(last, i, F.size(last) - i + 1), "."))
        prefixes = F.filter(F.array(*[F.lit(n) for n in sorted(lengths, reverse=True)]).cast("array<int>"), lambda n: n <= F.length(path))
        return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda n: F.concat(s, F.substr(path, F.lit(1), n)))))

    return F.when(F.length(host) > 0, let(F.split(host, r"\."), of)).otherwise(F.array().cast("array<string>"))


def build_index(rules: list[tuple[str, str]]) -> bytes:
    """The index file: number of rules, sorted keys, verdicts, string offsets, strings."""
    rows = sorted((xxhash.xxh64_intdigest(r.encode(), SEED), r.encode(), v) for r, v in rules)
    n, ends = len(rows), np.cumsum([0, *(len(r) for _, r, _ in rows)])
    keys = np.array([k for k, _, _ in rows], "<u8")
    return b"".join([np.array([n], "<u8").tobytes(), keys.tobytes(), ends.astype("<u8").tobytes(),
                     np.array([v == BLOCK for *_, v in rows], np.uint8).tobytes(), *(r for _, r, _ in rows)])


class Index:
    """The mapped file."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view("<u8")[0])
        self.keys, self.ends = raw[8:8 + 8 * n].view("<u8"), raw[8 + 8 * n:16 + 16 * n].view("<u8")
        self.blocks, self.text = raw[16 + 16 * n:16 + 17 * n], raw[16 + 17 * n:]

    def probe(self, digests: np.ndarray, strings: pa.Array) -> np.ndarray:
        """The rule of each string, or -1."""
        out = np.full(digests.size, -1, np.int64)
        if not self.keys.size:
            return out
        at = np.searchsorted(self.keys, digests)
        hits = np.flatnonzero(self.keys[np.minimum(at, self.keys.size - 1)] == digests)
        for i in hits.tolist():  # a hit counts if the stored string agrees; equal keys stand side by side
            want, j = strings[i].as_py().encode(), int(at[i])
            while j < self.keys.size and self.keys[j] == digests[i]:
                if self.text[int(self.ends[j]):int(self.ends[j + 1])].tobytes() == want:
                    out[i] = j
                    break
                j += 1
        return out

    def rule(self, j: int) -> str:
        return self.text[int(self.ends[j]):int(self.ends[j + 1])].tobytes().decode()


def _best(rules: DataFrame) -> DataFrame:
    """One row per rule string; ``block`` wins over ``allow``."""
    return rules.filter("rule IS NOT NULL AND verdict IS NOT NULL").groupBy("rule").agg(F.max("verdict").alias("verdict"))


def _ship(df: DataFrame, index: bytes) -> str:
    """Puts the file into the shared folder and has Spark copy it to every executor; returns its name there."""
    spark, name = df.sparkSession, f"rules-{uuid.uuid4().hex}.idx"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(index))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def _by_index(parts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    name = _ship(parts, build_index(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(SparkFiles.get(name))
        for b in batches:
            lists, digests = b.column("c"), b.column("k")
            found = index.probe(digests.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.flatten())
            cuts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            rule, verdict = [], []
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                hit = [j for j in found[x:y].tolist() if j >= 0]
                best = max(hit, key=lambda j: (int(index.ends[j + 1] - index.ends[j])), default=-1)  # the first of equals has the longer host
                rule.append(index.rule(best) if best >= 0 else None)
                verdict.append(BLOCK if best >= 0 and index.blocks[best] else ALLOW)
            yield pa.record_batch([b.column("page_id"), b.column("host"), b.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                  ["page_id", "host", "path", "rule", "verdict"])

    return parts.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def _by_join(parts: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for any number of rules: distinct (host, path) pairs meet the rules by key."""
    asked = parts.groupBy("host", "path").agg(F.first("c").alias("c"))
    met = (asked.select("host", "path", F.posexplode("c").alias("at", "rule")).join(rules, "rule")
           .groupBy("host", "path").agg(F.max(F.struct(F.octet_length("rule").alias("n"), (-F.col("at")).alias("near"), "rule", "verdict")).alias("best")))
    return (parts.join(met, ["host", "path"], "left")
            .select("page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict")))


def judge(pages: DataFrame, rules: DataFrame, max_rules: int = MAX_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page. ``rules``: rule, verdict (allow or block)."""
    best = _best(rules)
    paths = best.select(F.length(F.regexp_replace("rule", r"(?s)\A[^/]*", "")).alias("n")).distinct()
    lengths = [r["n"] for r in paths.collect()]  # path lengths, of which URLs allow some thousands
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    most = best.agg(F.max(F.size(F.split(F.substring_index("rule", "/", 1), r"\.")))).first()[0] or 0
    parts = parts.withColumn("c", candidates(F.col("host"), F.col("path"), lengths, most))
    head = best.limit(max_rules + 1).collect()
    if len(head) > max_rules:
        return _by_join(parts, best)
    return _by_index(parts.withColumn("k", F.transform("c", lambda x: F.xxhash64(x))), [(r["rule"], r["verdict"]) for r in head])
