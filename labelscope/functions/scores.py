"""Row-local expressions over score vectors and model keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelscope.functions.bind import bind

# First letter of a run key and the generation it stands for.
GENERATION = {
    "A": "Gen 1 · Klassisch (TF-IDF)",
    "B": "Gen 2 · Embeddings (frozen)",
    "C": "Gen 3a · Finetuning",
    "D": "Gen 3b · LLM",
}


def rounded(value: Column, digits: int) -> Column:
    """Rounding of the binary value. Spark's ``round`` works on the shortest decimal text, so a
    number just below a tie, such as 0.60325, would go up."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / scale


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column) -> Column:
    """Softmax, shifted by the row maximum."""
    powers = bind(
        logits, lambda z: bind(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp(x - top)))
    )
    return bind(powers, lambda p: bind(array_sum(p), lambda total: F.transform(p, lambda x: x / total)))


def vector_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x))


def l2_normalise(vector: Column) -> Column:
    """Vector of unit length; a zero vector stays as it is."""
    divisor = lambda norm: F.when(norm > 0, norm).otherwise(1.0)
    return bind(
        vector.cast("array<double>"),
        lambda v: bind(divisor(vector_norm(v)), lambda n: F.transform(v, lambda x: x / n)),
    )


def confidence(scores: Column) -> Column:
    return F.array_max(scores)


def argmax_label(scores: Column, classes: Column) -> Column:
    """Class with the highest score; the first one wins a tie."""
    place = bind(scores, lambda s: F.array_position(s, F.array_max(s)))
    return F.get(classes, place.cast("int") - 1)


def true_class_rank(scores: Column, classes: Column, y_true: Column) -> Column:
    """1 + number of classes placed above the true one; null if it is not a class.

    Equal scores keep the order of ``classes``.
    """
    place = F.array_position(classes, y_true).cast("int")

    def rank(s: Column) -> Column:
        return bind(
            F.get(s, place - 1),
            lambda own: F.size(F.filter(s, lambda x: x > own))
            + F.size(F.filter(F.slice(s, 1, place - 1), lambda x: x == own)) + 1,
        )

    return F.when(place > 0, bind(scores, rank).cast("bigint"))


def generation(model_key: Column) -> Column:
    """Generation name by first letter; an unknown letter is passed through."""
    table = F.create_map(*[F.lit(x) for pair in GENERATION.items() for x in pair])
    return F.coalesce(table[F.upper(F.substring(model_key, 1, 1))], F.substring(model_key, 1, 1))


def calibration_allowed(score_type: Column) -> Column:
    return F.coalesce(score_type == "proba", F.lit(False))


def ranking_allowed(score_type: Column) -> Column:
    return F.coalesce(score_type.isin("proba", "logits", "decision_function"), F.lit(False))
