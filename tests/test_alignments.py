"""Trimming with gaps, CIGAR walks and counting by pair, against plain loops."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from exprspark.operators import intervals as iv
from exprspark.operators import reads as rd


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def cut_place(read, adapter, min_overlap, errors):
    limit = int(len(adapter) * errors + 1e-9)
    cost = {}
    for s in range(len(read)):
        found = [edits(adapter, read[s:e]) for e in range(s, min(len(read), s + len(adapter) + limit) + 1)]
        found += [edits(adapter[:n], read[s:]) + limit - int(n * errors + 1e-9) for n in range(min_overlap, len(adapter)) if len(read) - s <= n + limit]
        if min(found) <= limit:
            cost[s] = min(found)
    if not cost:
        return len(read)
    first = min(cost)
    return min((c, s) for s, c in cost.items() if s <= first + limit)[1]


@pytest.mark.parametrize("adapter, min_overlap, errors", [("ACGTACGTAC", 3, 0.2), ("AGATCGGAAGAGC", 3, 0.1), ("AGATCGGAAGAGC", 1, 0.25), ("AC", 1, 0.0), ("CTGTCTCTTATACACATCTCTGATGGCGCG", 5, 0.15)])
def test_gapped_trimming_equals_dynamic_programming(adapter, min_overlap, errors):
    r = random.Random(len(adapter))
    reads = ["", "A", adapter, adapter[1:], adapter * 2, "N" * 40]
    for _ in range(400):
        read = "".join(r.choices("ACGT", k=r.randint(0, 60)))
        if r.random() < 0.8:
            piece = list(adapter[: r.randint(1, len(adapter))] if r.random() < 0.5 else adapter)
            for _ in range(r.randint(0, 3)):
                at = r.randrange(len(piece) + 1)
                piece[at:at + r.randint(0, 1)] = r.choices("ACGT", k=r.randint(0, 1))
            read += "".join(piece) + "".join(r.choices("ACGT", k=r.choice([0, 0, 5])))
        reads.append(read)
    keep = rd._gapped_places([x.encode() for x in reads], __import__("numpy").array([len(x) for x in reads]), adapter, min_overlap, errors)
    assert keep.tolist() == [cut_place(x, adapter, min_overlap, errors) for x in reads]


def test_gapped_trimming_of_a_table(spark):
    body = "TTTTTGGGGGTTTTTGGGGGTTTTTGGGGGTTTTTGG"
    rows = [("a", body + "AGATCGAAGAGCTT"), ("b", body + "AGATCGGTAAGAGCTT"), ("c", body), ("d", None)]  # one base missing, one extra
    reads = spark.createDataFrame([(i, s, s and "I" * len(s)) for i, s in rows], "read_id string, seq string, qual string")
    got = {r["read_id"]: (r["seq"], r["qual"]) for r in rd.trim_reads(reads, errors=0.1, gaps=True).collect()}
    assert got == {x: (body, "I" * len(body)) for x in "abc"}
    plain = {r["read_id"]: r["seq"] for r in rd.trim_reads(reads, errors=0.1).collect()}
    assert plain["a"] != body and plain["b"] != body


def walk(cigar, start):
    """(reference position, place in the read) of every aligned base."""
    out, ref, at, n = [], start, 0, ""
    for c in (cigar or "").replace("*", ""):
        if c.isdigit():
            n += c
            continue
        k, n = int(n), ""
        if c in "M=X":
            out += [(ref + i, at + i) for i in range(k)]
        ref += k if c in "MDN=X" else 0
        at += k if c in "MIS=X" else 0
    return out


CIGARS = ["10M", "3S7M", "2H4M3D6M", "4M2I4M", "1S3M1I2M5N2M1S4H", "5=1X4=", "2S8M2H", "6M4S", None, "*"]


def test_pileup_follows_the_cigar(spark):
    r = random.Random(4)
    rows = [("chr1", r.randint(0, 12), "".join(r.choices("ACGTN", k=10)), r.choice(CIGARS)) for _ in range(300)]
    got = rd.allele_fractions(spark.createDataFrame(rows, "chrom string, start long, seq string, cigar string"), 1, 0, 0.0).collect()
    want = Counter((pos, seq[i]) for _, start, seq, cigar in rows for pos, i in walk(cigar, start))
    mine = {(g["pos"], b): g[b.lower()] for g in got for b in "ACGT" if g[b.lower()]}
    assert mine == {k: v for k, v in want.items() if k[1] != "N"}


def test_clipped_bases_are_added_back(spark):
    rows = [(c, s, "1S3M" if c is None else c) for c, s in itertools.product(CIGARS[:-2], "+-")]
    df = spark.createDataFrame([(c, s, 100, 120) for c, s, _ in rows], "cigar string, strand string, start long, end long")
    got = {(r["cigar"], r["strand"]): r["five"] for r in df.withColumn("five", iv.five_prime(df)).collect()}
    lead = {"10M": 0, "3S7M": 3, "2H4M3D6M": 2, "4M2I4M": 0, "1S3M1I2M5N2M1S4H": 1, "5=1X4=": 0, "2S8M2H": 2, "6M4S": 0}
    tail = {"10M": 0, "3S7M": 0, "2H4M3D6M": 0, "4M2I4M": 0, "1S3M1I2M5N2M1S4H": 5, "5=1X4=": 0, "2S8M2H": 2, "6M4S": 4}
    assert got == {**{(c, "+"): 100 - n for c, n in lead.items()}, **{(c, "-"): 120 + n for c, n in tail.items()}}
    same = spark.createDataFrame(
        [("s", "r1", "c", 100, 110, "+", "10M"), ("s", "r2", "c", 103, 110, "+", "3S7M"), ("s", "r3", "c", 103, 110, "+", "7M")],
        "sample_id string, read_id string, chrom string, start long, end long, strand string, cigar string")
    assert {r["read_id"]: r["is_duplicate"] for r in iv.mark_duplicates(same).collect()} == {"r1": False, "r2": True, "r3": False}
    assert not any(r["is_duplicate"] for r in iv.mark_duplicates(same.drop("cigar")).filter("read_id = 'r2'").collect())


def brute_count(records, features, key):
    """Records with one key are one fragment."""
    met = {}
    for rec in records:
        hits = {f for f, c, s, e in features if c == rec[1] and s < max(rec[3], rec[2] + 1) and e > rec[2]}
        met.setdefault(key(rec), set()).update(hits)
    return Counter(("no_feature", None) if not m else ("assigned", *m) if len(m) == 1 else ("ambiguous", None) for m in met.values())


@pytest.mark.parametrize("tile", [4, 1 << 20])
def test_counts_by_read_and_by_pair(spark, tile):
    """Nested, touching, stacked and many-part features; reads of no length; mates on different features and sequences; tiles much smaller than a read."""
    r = random.Random(9)
    features = [(f"f{r.randrange(12)}", r.choice(["c1", "c2"]), s, s + r.randint(1, 25)) for s in (r.randint(0, 150) for _ in range(30))]
    features += [("g1", "c1", 200, 210), ("g2", "c1", 210, 220), ("g1", "c1", 230, 240), ("g3", "c3", 0, 5)]
    records = [(f"r{r.randrange(250)}", r.choice(["c1", "c2", "c3", "c4"]), s, s + r.choice([0, 1, 5, 40])) for s in (r.randint(0, 260) for _ in range(600))]
    fs = spark.createDataFrame(features, "interval_id string, chrom string, start long, end long")
    rs = spark.createDataFrame([("s", *x) for x in records], "sample_id string, read_id string, chrom string, start long, end long")
    for by_pair, key in ((False, lambda x, n=itertools.count(): next(n)), (True, lambda x: x[0])):
        got = iv.count_overlaps(rs, fs, tile=tile, by_pair=by_pair)
        assert {(g["status"], g["interval_id"]): g["n"] for g in got.collect()} == brute_count(records, features, key)
    none = iv.count_overlaps(rs, fs.limit(0), by_pair=True).collect()
    assert [(g["status"], g["n"]) for g in none] == [("no_feature", len({x[0] for x in records}))]
    assert iv.count_overlaps(rs.limit(0), fs).count() == 0


@pytest.mark.parametrize("tile", [16, 1 << 20])
def test_large_tiles_are_dealt_to_several_windows(spark, monkeypatch, tile):
    """Every window of a tile has all its pieces and what earlier tiles end with; records without a place meet nothing."""
    r = random.Random(4)
    features = [(f"f{r.randrange(9)}", r.choice(["c1", "c2"]), s, s + r.randint(1, 60)) for s in (r.randint(0, 150) for _ in range(20))]
    records = [(f"r{i}", "c1", s, s + r.choice([0, 3, 50])) for i, s in enumerate(r.randint(0, 60) for _ in range(500))] + [("q", "c2", 70, 80)] * 200
    lost = [("n1", None, 5, 9), ("n2", "c1", None, None), ("n3", "c1", None, 9), ("n4", None, None, None)]
    fs = spark.createDataFrame([*features, ("nowhere", None, 0, 100)], "interval_id string, chrom string, start int, end int")
    endless = [(f"e{i}", "c1", i, None) for i in range(0, 60, 7)]  # a read of one base; as a record of a fragment it meets nothing
    rs = spark.createDataFrame([("s", *x) for x in records + lost + endless], "sample_id string, read_id string, chrom string, start int, end int")
    monkeypatch.setattr(iv, "PART_ROWS", 20)
    for by_pair, key in ((False, lambda x, n=itertools.count(): next(n)), (True, lambda x: x[0])):
        short = [] if by_pair else [(i, c, a, a) for i, c, a, _ in endless]
        want = brute_count(records + short, features, key) + Counter({("no_feature", None): len(lost) + len(endless) - len(short)})
        assert {(g["status"], g["interval_id"]): g["n"] for g in iv.count_overlaps(rs, fs, tile=tile, by_pair=by_pair).collect()} == want


def test_one_pair_on_two_features_is_ambiguous(spark):
    fs = spark.createDataFrame([("a", "c", 0, 10), ("b", "c", 50, 60)], "interval_id string, chrom string, start long, end long")
    rs = spark.createDataFrame(
        [("s", "x", "c", 1, 5), ("s", "x", "c", 52, 55), ("s", "y", "c", 1, 5), ("s", "y", "c", 20, 30), ("s", "z", "c", 20, 25), ("t", "x", "c", 1, 5)],
        "sample_id string, read_id string, chrom string, start long, end long")
    got = {(g["sample_id"], g["status"], g["interval_id"]): g["n"] for g in iv.count_overlaps(rs, fs, by_pair=True).collect()}
    assert got == {("s", "ambiguous", None): 1, ("s", "assigned", "a"): 1, ("s", "no_feature", None): 1, ("t", "assigned", "a"): 1}
    assert iv.count_overlaps(rs, fs, by_pair=True).agg(F.sum("n")).first()[0] == 4
