"""Class labels and their ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts and class ids.
NEGATIVE_ID, POSITIVE_ID, OTHER_ID = 0, 1, 2
CLASS_IDS = (NEGATIVE_ID, POSITIVE_ID, OTHER_ID)
POS, NEU, NEG = "POS", "NEU", "NEG"


def given_class_id(sentiment: Column) -> Column:
    """positive 1, negative 0, anything else or nothing 2."""
    return (
        F.when(sentiment == "positive", F.lit(POSITIVE_ID))
        .when(sentiment == "negative", F.lit(NEGATIVE_ID))
        .otherwise(F.lit(OTHER_ID))
    )


def predicted_class_id(label: Column) -> Column:
    """POS 1, all else 0: a neutral prediction counts as not positive."""
    return F.when(label == POS, F.lit(POSITIVE_ID)).otherwise(F.lit(NEGATIVE_ID))
