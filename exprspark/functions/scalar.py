"""Column expressions: names, labels, p-value transforms. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The smallest positive normal double and the broad cell classes.
DOUBLE_XMIN = 2.2250738585072014e-308
CELL_CLASSES = ("Astro", "Endo", "Exc", "Inh", "Micro", "Oligo", "OPC", "VLMC")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_version(col: str | Column) -> Column:
    """``ENSG0001.7`` -> ``ENSG0001``."""
    return F.substring_index(_c(col), ".", 1)


def basename(col: str | Column) -> Column:
    return F.element_at(F.split(_c(col), "/"), -1)


def sub_first(col: str | Column, pattern: str, replacement: str = "") -> Column:
    """Replace the first match only."""
    return F.regexp_replace(_c(col), f"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def make_names(col: str | Column) -> Column:
    """Syntactic names: other characters become dots, a leading digit or mark gets an X."""
    dotted = F.regexp_replace(_c(col), r"[^\p{L}\p{N}._]", ".")
    bad_start = dotted.rlike(r"^(?:[0-9_]|\.[0-9])") | (F.length(dotted) == 0)
    return F.when(bad_start | ~_c(col).rlike(r"^[\p{L}.]"), F.concat(F.lit("X"), dotted)).otherwise(dotted)


def clean_sample_name(col: str | Column, rules: Sequence[tuple[str, str]] = (), syntactic: bool = False) -> Column:
    """File name without folders, then each (pattern, replacement) once, then optional make_names."""
    out = basename(col)
    for pattern, replacement in rules:
        out = sub_first(out, pattern, replacement)
    return make_names(out) if syntactic else out


def before_first(col: str | Column, sep: str = "_") -> Column:
    return F.substring_index(_c(col), sep, 1)


def direction(log_fc: str | Column, up: str = "UP", down: str = "DN") -> Column:
    """UP above zero, DN below; zero is neither."""
    c = _c(log_fc)
    return F.when(c > 0, up).when(c < 0, down)


def two_way_label(log_fc: str | Column) -> Column:
    """Upregulated above zero, else Downregulated (zero included)."""
    return F.when(_c(log_fc) > 0, "Upregulated").otherwise("Downregulated")


def regulation(log_fc: str | Column, fdr: str | Column, min_fc: float = 1.0, max_fdr: float = 0.3) -> Column:
    """Up / Down / Normal by fold change and adjusted p."""
    sig = _c(fdr) < max_fdr
    return F.when(sig & (_c(log_fc) >= min_fc), "Up").when(sig & (_c(log_fc) <= -min_fc), "Down").otherwise("Normal")


def volcano_class(log_fc: str | Column, p: str | Column, fc_cut: float = 0.4, p_cut: float = 0.05) -> Column:
    """Four classes: not significant, fold change only, p only, both."""
    big, sig = F.abs(_c(log_fc)) > fc_cut, _c(p) < p_cut
    return F.when(big & sig, "FC_P").when(sig, "P").when(big, "FC").otherwise("NS")


def neg_log10(p: str | Column, floor: float = DOUBLE_XMIN) -> Column:
    """``-log10(p)``, with p = 0 replaced by the smallest normal double."""
    c = _c(p)
    return F.when(c == 0, -F.log10(F.lit(floor))).otherwise(-F.log10(c))


def signed_log10p(p: str | Column, sign_of: str | Column) -> Column:
    """``-log10(p)``, positive where the sign column is above zero, else negative."""
    return neg_log10(p) * F.when(_c(sign_of) > 0, 1.0).otherwise(-1.0)


def truncate_label(col: str | Column, width: int = 50) -> Column:
    c = _c(col)
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width - 3), F.lit("..."))).otherwise(c)


def prefix_recode(col: str | Column, classes: Sequence[str] = CELL_CLASSES) -> Column:
    """The first class the value starts with, else the value itself."""
    out = F.when(F.lit(False), _c(col))
    for name in classes:
        out = out.when(_c(col).startswith(name), name)
    return out.otherwise(_c(col))


def sparse_label(col: str | Column, chosen: Sequence[str]) -> Column:
    """The label of chosen entries only."""
    return F.when(_c(col).isin(list(chosen)), _c(col))


def sci(col: str | Column, digits: int = 2) -> Column:
    """Scientific notation text, for report tables."""
    return F.format_string(f"%.{digits}e", _c(col).cast("double"))


def sorted_list(col: str | Column, sep: str, out_sep: str = "/") -> Column:
    """Sort the parts of a delimited text."""
    return F.array_join(F.array_sort(F.split(_c(col), sep)), out_sep)
