"""Generated sentences: a balanced corpus for trials without data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.fixed_values import EMOTIONS, SEED
from textloom.functions.keys import choose, order_key

# Per class: sentences and the words that may fill their gap.
TEMPLATES = {
    "sadness": ["The house has been {} since they moved out.", "I stayed in bed, {} again.",
                "The letter left me {} for days."],
    "joy": ["We danced all night, {} as children.", "The garden is in bloom and I am {}.",
            "What a {} morning by the lake!"],
    "love": ["I am {} of the way you laugh.", "Hold my hand, my {} one.",
             "My heart is {} whenever you call."],
    "anger": ["I am {} about the broken promise.", "They lied again and I was {}.",
              "Such {} rudeness at the counter!"],
    "fear": ["The dark stairs made me {}.", "I am {} of what the doctor will say.",
             "A {} noise came from the cellar."],
    "surprise": ["I was {} by the ending!", "A {} visitor stood at the door.",
                 "Nobody saw that coming, we were {}."],
}
FILLS = {
    "sadness": ["empty", "gloomy", "tearful", "hollow"],
    "joy": ["cheerful", "delighted", "sunny", "merry"],
    "love": ["fond", "dearest", "tender", "devoted"],
    "anger": ["furious", "bitter", "outraged", "livid"],
    "fear": ["uneasy", "afraid", "dreadful", "anxious"],
    "surprise": ["startled", "unexpected", "astonished", "speechless"],
}


def synthetic_corpus(ids: DataFrame, seed: int = SEED, id_col: str = "id") -> DataFrame:
    """One sentence per id: classes in turn, template and fill drawn from the id.

    `shuffle_key` is the seeded order; a table in Spark has no order of its own.
    """
    texts = F.array(*[F.array(*map(F.lit, TEMPLATES[e])) for e in EMOTIONS])
    fills = F.array(*[F.array(*map(F.lit, FILLS[e])) for e in EMOTIONS])
    label = F.pmod(F.col(id_col), F.lit(len(EMOTIONS))).cast("int")

    def pick(options: Column, salt: str) -> Column:
        of_class = F.get(options, label)
        return F.get(of_class, choose(id_col, F.size(of_class), seed, salt))

    return ids.select(
        F.col(id_col).alias("id"),
        F.replace(pick(texts, "template"), F.lit("{}"), pick(fills, "fill")).alias("text"),
        label.alias("label"),
        F.get(F.array(*map(F.lit, EMOTIONS)), label).alias("emotion"),
        order_key(id_col, seed).alias("shuffle_key"),
    )
