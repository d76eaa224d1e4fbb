"""Fixed schemas of the data model; readers pass them instead of inferring types."""

from pyspark.sql import types as T


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_str, _int, _long, _dbl = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

MATRIX = _s(("feature_id", _str), ("sample_id", _str), ("count", _dbl))
SAMPLES = _s(("sample_id", _str), ("group", _str))
ANNOTATIONS = _s(
    ("feature_id", _str), ("symbol", _str), ("biotype", _str), ("description", _str),
    ("chrom", _str), ("start", _long), ("end", _long), ("entrez_id", _str),
)
DEG = _s(
    ("feature_id", _str), ("log_fc", _dbl), ("log_cpm", _dbl), ("lr", _dbl), ("p_value", _dbl),
    ("fdr", _dbl), ("symbol", _str), ("biotype", _str), ("description", _str),
)
GENE_SETS = _s(("collection", _str), ("term_id", _str), ("feature_id", _str))
STAR_COUNTS = _s(("gene_id", _str), ("unstranded", _long), ("strand1", _long), ("strand2", _long))
FEATURECOUNTS = _s(
    ("Geneid", _str), ("Chr", _str), ("Start", _str), ("End", _str), ("Strand", _str),
    ("Length", _str), ("n", _str),
)
COUNT_STATUS = _s(("status", _str), ("n", _str))
BED3 = _s(("chrom", _str), ("start", _long), ("end", _long))
BED6 = _s(
    ("chrom", _str), ("start", _long), ("end", _long), ("name", _str), ("score", _dbl),
    ("strand", _str),
)
BEDGRAPH = _s(("chrom", _str), ("start", _long), ("end", _long), ("value", _dbl))
NARROWPEAK = _s(
    ("chrom", _str), ("start", _long), ("end", _long), ("name", _str), ("score", _dbl),
    ("strand", _str), ("signal", _dbl), ("neg_log10_p", _dbl), ("neg_log10_q", _dbl), ("summit", _long),
)
SAF = _s(("name", _str), ("chrom", _str), ("start", _long), ("end", _long), ("strand", _str))
CHROMSIZES = _s(("chrom", _str), ("size", _long))
READS = _s(("file", _str), ("read_id", _str), ("seq", _str), ("qual", _str), ("mate", _int))
ENRICHMENT = _s(
    ("collection", _str), ("direction", _str), ("term_id", _str), ("gene_ratio", _str),
    ("bg_ratio", _str), ("p_value", _dbl), ("p_adjust", _dbl), ("q_value", _dbl),
    ("count", _long), ("genes", T.ArrayType(_str)),
)
