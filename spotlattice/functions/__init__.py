"""Column functions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Gene-name prefixes by species.
MITO = {"mouse": ("mt-",), "human": ("MT-",)}
RIBO = {"mouse": ("Rps", "Rpl"), "human": ("RPS", "RPL")}


def share(part: Column, whole: Column, otherwise: float | None = None) -> Column:
    """part / whole as a double; ``otherwise`` where whole is 0 or null."""
    out = F.try_divide(part.cast("double"), whole.cast("double"))
    return out if otherwise is None else F.coalesce(out, F.lit(float(otherwise)))


def starts_with_any(name: Column, prefixes: tuple[str, ...]) -> Column:
    """Whether a name starts with one of the prefixes, whatever the case; null names do not."""
    out = F.lit(False)
    for p in prefixes:
        out = out | F.coalesce(F.startswith(F.lower(name), F.lit(p.lower())), F.lit(False))
    return out


def cluster_order(label: Column) -> list[Column]:
    """Numbers in their order, then other labels."""
    return [label.try_cast("int").asc_nulls_last(), label.asc()]


def run_tag(prob: Column, nms: Column, growth: Column, key: Column) -> Column:
    return F.format_string("sdP%.2f_sdN%.2f_vpx%d_cl%s", prob, nms, growth, key)


#: Twenty colours that plots go through.
COLOURS = (
    "#1f77b4", "#ff7f0e", "#2ca02c", "#d62728", "#9467bd", "#8c564b", "#e377c2", "#7f7f7f", "#bcbd22", "#17becf",
    "#aec7e8", "#ffbb78", "#98df8a", "#ff9896", "#c5b0d5", "#c49c94", "#f7b6d2", "#c7c7c7", "#dbdb8d", "#9edae5",
)


def colour(place: Column) -> Column:
    """The colour of the place-th cluster, from 0, going round."""
    return F.element_at(F.array(*[F.lit(c) for c in COLOURS]), (F.pmod(place, F.lit(len(COLOURS))) + 1).cast("int"))


def pixels_of(um: Column, um_per_px: float) -> Column:
    """Micrometres as pixels; raises where a pixel has no size."""
    if um_per_px <= 0:
        raise ValueError("a pixel needs a size")
    return um / F.lit(float(um_per_px))


def cell_name(number: Column) -> Column:
    return F.concat(F.lit("cell_"), number.cast("string"))


def without_suffix(name: Column, *suffixes: str) -> Column:
    """``name`` without the first of the suffixes that ends it; a name that is nothing else stays."""
    out = name
    for s in reversed(suffixes):
        out = F.when(F.endswith(name, F.lit(s)) & (F.length(name) > len(s)), F.left(name, F.length(name) - F.lit(len(s)))).otherwise(out)
    return out


def shell_quoted(text: Column) -> Column:
    """One word of a POSIX shell."""
    plain = text.rlike(r"^[A-Za-z0-9_@%+=:,./-]+$")
    return F.when(plain, text).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("'\"'\"'")), F.lit("'")))


def day_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def common_prefix(names: Column) -> Column:
    """Longest prefix that all of an array of names have; null for none."""

    def both(a: Column, b: Column) -> Column:
        n = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(a), F.length(b)))), lambda k: (F.left(a, k) == F.left(b, k)) & (k <= F.least(F.length(a), F.length(b)))))
        return F.left(a, n)

    return F.when(F.size(names) > 0, F.aggregate(names, names[0], both))
