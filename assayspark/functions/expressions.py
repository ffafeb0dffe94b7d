"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN_PATTERN = "^([0-9]+)_"
TRIAL_PATTERN = "rep([0-9]+)"
CURVE_POINT_PATTERN = "_P([0-9]+_*[0-9]*)-"


def extract_int(col: Column | str, pattern: str) -> Column:
    """First capture group as bigint; NULL where the pattern does not match."""
    found = F.regexp_extract(col, pattern, 1)
    return F.nullif(found, F.lit("")).try_cast("bigint")


def extract_curve_point(col: Column | str) -> Column:
    """Curve point written as ``_P0_5-`` (0.5); NULL where absent or malformed."""
    found = F.nullif(F.regexp_extract(col, CURVE_POINT_PATTERN, 1), F.lit(""))
    return F.replace(found, F.lit("_"), F.lit(".")).try_cast("double")


def label_part(col: Column | str) -> Column:
    """Text of one id part: NULL reads ``NA`` and a whole number carries no ``.0``."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(F.regexp_replace(text, r"^(-?[0-9]+)\.0$", "$1"), F.lit("NA"))


def joined_label(*parts: Column | str, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[label_part(p) for p in parts])


def precursor_label(peptide_mods="peptide_mods", charge="precursor_charge") -> Column:
    return F.concat(label_part(peptide_mods), F.lit("_"), label_part(charge), F.lit("+"))


def transition_label(
    peptide_mods="peptide_mods",
    charge="precursor_charge",
    fragment="fragment_ion",
    fragment_charge="product_charge",
) -> Column:
    return F.concat(
        precursor_label(peptide_mods, charge),
        F.lit("-->"), label_part(fragment),
        F.lit("_"), label_part(fragment_charge), F.lit("+"),
    )


def firstcap(col: Column | str) -> Column:
    """Upper-case the first character only."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.upper(F.substring(c, 1, 1)), c.substr(F.lit(2), F.length(c)))


def percent(col: Column, digits: int = 2) -> Column:
    """``0.125`` as ``12.50%``; NULL stays NULL."""
    hundredfold = F.round(100 * col, digits)
    return F.when(col.isNotNull(), F.concat(F.format_string(f"%.{digits}f", hundredfold), F.lit("%")))


def hyperbolic_threshold(
    col: Column, fc: float = 1.0, alpha: float = 0.05, c: float = 0.5, symmetric: bool = False
) -> Column:
    """Volcano cut-off c/|x-fc| - log10(alpha); infinite where x equals fc."""
    x = F.abs(col) if symmetric else col
    curve = F.try_divide(F.lit(float(c)), F.abs(x - F.lit(float(fc))))
    at_pole = F.when(x == F.lit(float(fc)), F.lit(float("inf"))).otherwise(curve)
    return at_pole - F.log10(F.lit(float(alpha)))


def ratio_or_area(ratio: Column, light_area: Column, heavy_area: Column) -> Column:
    """A reported ratio of 0 gives way to the area ratio; NULL stays NULL."""
    return F.when(ratio == 0, F.try_divide(light_area, heavy_area)).otherwise(ratio)


def floor_zero(col: Column, replacement: float = 1.0) -> Column:
    return F.when(col == 0, F.lit(float(replacement))).otherwise(col)


def fold_change(pre: Column, post: Column) -> Column:
    return F.try_divide(pre, post)


def log2_positive(col: Column) -> Column:
    return F.when(col > 0, F.log2(col))


def log10_positive(col: Column) -> Column:
    return F.when(col > 0, F.log10(col))


def recode(col: Column, mapping: Mapping[str, object]) -> Column:
    """Replace listed values, keep the others."""
    return reduce(
        lambda expr, item: expr.when(col == F.lit(item[0]), F.lit(item[1])),
        mapping.items(),
        F.when(F.lit(False), F.lit(None)),
    ).otherwise(col)


def binary_class(col: Column, positive: str) -> Column:
    return F.when(col.isNotNull(), F.when(col == F.lit(positive), 1).otherwise(0))


def logit_cutoff(intercept: Column, slope: Column, threshold: float = 0.5) -> Column:
    """Concentration at which the fitted probability equals the threshold."""
    odds = F.lit(float(threshold) / (1.0 - float(threshold)))
    return F.try_divide(F.ln(odds) - intercept, slope)


def logistic(intercept: Column, slope: Column, x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-(intercept + slope * x)))


def signal_to_noise(area: Column, background: Column) -> Column:
    return F.try_divide(area, background)


def mass_concentration(molar: Column, weight: Column) -> Column:
    """fmol per microlitre times molecular weight, as microgram per millilitre."""
    return molar * weight * F.lit(1e-6)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Missing intensities count as 0; a background of 0 or NULL counts as 1."""
    zero = ["area", "lth", "rdotp", "max_height", "transition_rank", "retention_time"]
    filled = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in zero if c in df.columns}
    background = F.col("background")
    filled["background"] = F.when(background.isNull() | (background == 0), F.lit(1.0)).otherwise(background)
    return df.withColumns(filled)


def select_first(df: DataFrame, names: list[str]) -> DataFrame:
    """Named columns first, the others after them in their old order."""
    return df.select(*names, *[c for c in df.columns if c not in names])


# Wichura's rational approximations of the normal quantile, highest power first.
_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
_FLANK = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258,
     3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0),
)
_END = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


def _ratio(coefficients: tuple, x: Column) -> Column:
    top, bottom = (reduce(lambda total, c: total * x + c, part[1:], F.lit(part[0])) for part in coefficients)
    return top / bottom


def normal_quantile(p: Column) -> Column:
    """Standard normal quantile, to about the last digit; infinite at 0 and 1, NULL outside."""
    off = p - 0.5
    root = F.sqrt(-F.ln(F.least(p, 1 - p)))
    flank = F.when(root <= 5, _ratio(_FLANK, root - 1.6)).otherwise(_ratio(_END, root - 5))
    inside = F.when(F.abs(off) <= 0.425, off * _ratio(_CENTRE, 0.180625 - off * off)).otherwise(F.signum(off) * flank)
    return F.when(p == 0, F.lit(float("-inf"))).when(p == 1, F.lit(float("inf"))).when((p > 0) & (p < 1), inside)
