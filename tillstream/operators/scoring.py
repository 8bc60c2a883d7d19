"""Age-band scoring rules as data (SCO-1 … SCO-7, TOP-2).

Rules are one small weight table ``(model, match, w_18_24 … w_50)`` joined by
broadcast (a fixed, bounded table), not a chain of ``when`` branches.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import fixed_table

BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]
# The band labels in output order (ties go to the first).
BAND_LABELS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50以上"]

# Rule weights before the model coefficient, bands in the order above.
WEIGHTS = [
    ("device", "iOS", 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    ("device", "Android", 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),
    ("search", "时尚与潮流", 0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    ("search", "性价比", 0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    ("search", "健康与养生", 0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    ("search", "家庭与育儿", 0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    ("search", "科技与数码", 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    ("search", "学习与发展", 0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
    ("price", "0-1000", 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    ("price", "1000-4000", 0.2, 0.4, 0.6, 0.7, 0.8, 0.7),
    ("price", "other", 0.1, 0.2, 0.3, 0.4, 0.5, 0.6),
    ("brand", "苹果", 0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    ("brand", "欧莱雅", 0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    ("brand", "香奈儿", 0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    ("brand", "Redmi", 0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    ("brand", "联想", 0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    ("brand", "长粒香", 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    ("brand", "金沙河", 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    ("brand", "__default__", 0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
    ("category", "时尚与潮流", 0.9, 0.7, 0.5, 0.3, 0.2, 0.1),
    ("category", "性价比", 0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    ("category", "健康与养生", 0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    ("category", "家庭与育儿", 0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    ("category", "科技与数码", 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),
    ("category", "学习与发展", 0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
]
# Model coefficients.
COEFFICIENTS = {"device": 0.1, "search": 0.15, "price": 0.15, "brand": 0.2, "category": 0.3}

SCORE_TYPE = "decimal(10,3)"


def weight_table(spark: SparkSession, model: str, compat: bool = False) -> DataFrame:
    """``match`` + one score column per band for one model: ``round(w * coef, 3)``.
    ``compat=True`` reproduces the reference's category rule, whose cases all
    fall through to zero."""
    rows = [r[1:] for r in WEIGHTS if r[0] == model]
    df = fixed_table(spark, rows, "match string, " + ", ".join(f"w_{b} double" for b in BANDS))
    coef = COEFFICIENTS[model]
    return F.broadcast(df.select("match", *[
        (F.lit(0) if compat and model == "category" else F.round(F.col(f"w_{b}") * coef, 3))
        .cast(SCORE_TYPE).alias(f"{model}_{b}") for b in BANDS]))


def default_scores(model: str, match: str | None, compat: bool = False) -> dict[str, Decimal]:
    """Scores of one rule row as literals (``round(w * coef, 3)`` half up)."""
    row = next((r for r in WEIGHTS if r[0] == model and r[1] == match), None)
    out = {}
    for i, b in enumerate(BANDS):
        w = 0.0 if row is None or (compat and model == "category") else row[2 + i] * COEFFICIENTS[model]
        out[f"{model}_{b}"] = Decimal(repr(w)).quantize(Decimal("0.001"), ROUND_HALF_UP)
    return out


def weight_score(df: DataFrame, weights: DataFrame, match_col: str, model: str,
                 default_match: str | None = None, compat: bool = False) -> DataFrame:
    """Left-join the model's weights on ``match_col``; a miss takes the
    ``default_match`` rule when given, else zero."""
    cols = [f"{model}_{b}" for b in BANDS]
    j = df.join(weights, df[match_col].eqNullSafe(weights["match"]), "left").drop("match")
    dflt = default_scores(model, default_match, compat)
    return j.select(*[c for c in j.columns if c not in cols],
                    *[F.coalesce(F.col(c), F.lit(dflt[c]).cast(SCORE_TYPE)).alias(c) for c in cols])


def price_bucket(amount) -> Column:
    """SCO-3: [0, 1000] → ``0-1000``; (1000, 4000] → ``1000-4000``; else ``other``."""
    a = F.col(amount).try_cast("decimal(20,2)") if isinstance(amount, str) else amount
    return (F.when((a >= 0) & (a <= 1000), F.lit("0-1000"))
             .when((a > 1000) & (a <= 4000), F.lit("1000-4000")).otherwise(F.lit("other")))


def pick_band(totals: list[Column]) -> Column:
    """TOP-2: label of the largest total; the first band wins ties."""
    arr = F.array(*totals)
    pos = F.array_position(arr, F.array_max(arr))
    return F.element_at(F.array(*[F.lit(b) for b in BAND_LABELS]), pos.cast("int"))
