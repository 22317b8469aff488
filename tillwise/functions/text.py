"""Tokens, lexicon and the text score, without Python per row."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Polarity words (English and Portuguese).
POSITIVE_WORDS = [
    "good", "great", "excellent", "amazing", "wonderful", "fantastic",
    "perfect", "love", "loved", "best", "happy", "satisfied", "recommend",
    "quality", "fast", "quick", "easy", "beautiful", "nice", "super",
    "bom", "ótimo", "excelente", "maravilhoso", "perfeito", "amo",
    "melhor", "feliz", "satisfeito", "recomendo", "qualidade", "rápido",
    "lindo", "incrível", "fantástico", "top", "show", "demais",
]
# As above, negative.
NEGATIVE_WORDS = [
    "bad", "terrible", "awful", "horrible", "worst", "hate", "disappointed",
    "poor", "slow", "late", "damaged", "broken", "wrong", "never", "not",
    "ruim", "terrível", "horrível", "pior", "ódio", "odeio", "decepcionado",
    "pobre", "lento", "atrasado", "danificado", "quebrado", "errado",
    "nunca", "não", "problema", "defeito", "atraso", "demora",
]
# Factors of intensifying words.
INTENSIFIERS = {
    "very": 1.5, "really": 1.5, "extremely": 2.0, "absolutely": 2.0,
    "muito": 1.5, "extremamente": 2.0, "totalmente": 2.0, "demais": 1.5,
}
# Negating words.
NEGATORS = ["not", "no", "never", "don't", "doesn't", "won't", "não", "nunca", "jamais"]
# Words that are no keywords.
STOPWORDS = [
    "this", "that", "with", "have", "from", "they", "will", "would",
    "there", "their", "what", "about", "more", "when", "were", "very",
    "como", "para", "com", "não", "tem", "muito", "foi", "vou", "faz",
]


@dataclass(frozen=True)
class Lexicon:
    positive: tuple[str, ...] = tuple(POSITIVE_WORDS)
    negative: tuple[str, ...] = tuple(NEGATIVE_WORDS)
    intensifiers: Mapping[str, float] = field(default_factory=lambda: dict(INTENSIFIERS))
    negators: tuple[str, ...] = tuple(NEGATORS)


def tokens(text: Column) -> Column:
    """Lower-case words; (?U) keeps accented letters inside words."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w+\b"), F.lit(0))


def keyword_tokens(text: Column) -> Column:
    """Words of at least four plain letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b[a-zA-Z]{4,}\b"), F.lit(0))


def text_sentiment(text: Column, lexicon: Lexicon = Lexicon()) -> Column:
    """Lexicon score in -1..1.

    A word's weight is the intensifier among the modifiers right before it; a negator
    there flips it at half strength. Modifiers apply to the next other word only.
    """

    def weight_of(word: Column) -> Column:
        found = F.lit(1.0)
        for entry, weight in lexicon.intensifiers.items():
            found = F.when(word == entry, F.lit(weight)).otherwise(found)
        return found

    def state(total: Column, weight: Column, negated: Column, words: Column) -> Column:
        return F.struct(
            total.alias("total"), weight.alias("weight"), negated.alias("negated"),
            words.alias("words"),
        )

    def step(acc: Column, word: Column) -> Column:
        seen = acc["words"] + 1
        polarity = (
            F.when(word.isin(*lexicon.positive), 1.0)
            .when(word.isin(*lexicon.negative), -1.0)
            .otherwise(0.0)
        )
        flip = F.when(acc["negated"], F.lit(-0.5)).otherwise(F.lit(1.0))
        gained = acc["total"] + polarity * acc["weight"] * flip
        return (
            F.when(
                word.isin(*lexicon.intensifiers),
                state(acc["total"], weight_of(word), acc["negated"], seen),
            )
            .when(
                word.isin(*lexicon.negators),
                state(acc["total"], acc["weight"], F.lit(True), seen),
            )
            .otherwise(state(gained, F.lit(1.0), F.lit(False), seen))
        )

    def finish(acc: Column) -> Column:
        length = F.greatest(F.sqrt(acc["words"].cast("double")), F.lit(1.0))
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), acc["total"] / length))

    start = state(F.lit(0.0), F.lit(1.0), F.lit(False), F.lit(0))
    return F.aggregate(tokens(F.coalesce(text, F.lit(""))), start, step, finish)
