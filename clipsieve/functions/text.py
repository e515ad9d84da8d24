"""Text expressions of the reading check. All are built-in Spark expressions, but for Unicode composition.

Null stays null unless a function says otherwise.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as the reference's language defines it, in Java's notation.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
#: Characters that aren't letters, digits, underscores, white space, or of the Mongolian and Cyrillic blocks. The usual
#: ones come first, where a class is decided soonest.
_OTHER = r"[^\x{0400}-\x{04FF} a-z0-9\x{1800}-\x{18AF}\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}]"
#: White space that isn't a single plain space.
_UNEVEN = r"[\s\x1c-\x1f\x85\p{Z}]{2,}|[\s\x1c-\x1f\x85\p{Z}&&[^ ]]"
#: A text with one of these may need composition. (Naming the other characters, negated, takes three times as long.)
_MAY_COMPOSE = r"[\x{0300}-\x{03FF}\x{0483}-\x{0489}\x{0530}-\x{17FF}\x{1885}-\x{2001}\x{2070}-\x{10FFFF}]"


def nfc(text: Column, raw: Column | None = None) -> Column:
    """Unicode composition (NFC). Only texts that may need it go to Python, in Arrow batches.

    Whether a text may need it is read from ``raw`` if given: the text before changes that can't bring in marks.
    """

    @F.arrow_udf(StringType())
    def composed(batch: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in batch.to_pylist()], pa.string())

    needed = (text if raw is None else raw).rlike(_MAY_COMPOSE)
    return F.when(needed, composed(F.when(needed, text))).otherwise(text)


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def normalise(text: Column) -> Column:
    """Lower case, composed, letters and digits only, single spaces.

    White space at the ends needs no step of its own before composition, as it never composes with a mark.
    """
    # the one mark that lower case brings in, on the dotted capital I, never composes
    kept = F.regexp_replace(nfc(F.lower(text), text), _OTHER, "")
    return F.trim(F.regexp_replace(kept, _UNEVEN, " "))


def cer(truth: Column, heard: Column) -> Column:
    """Character error rate of normalised texts: edits over the truth's length; 1 for an empty truth."""
    edits = F.when(truth == heard, F.lit(0)).otherwise(F.levenshtein(truth, heard))
    return F.when(F.char_length(truth) == 0, F.lit(1.0)).otherwise(edits / F.greatest(F.char_length(truth), F.lit(1)))


def length_ratio(truth: Column, heard: Column) -> Column:
    return F.char_length(heard) / F.greatest(F.char_length(truth), F.lit(1))


def fixed(x: Column, digits: int) -> Column:
    """A number with so many decimals, rounded as binary floating point formats are."""
    return F.call_function("format_number", x, F.lit("0." + "0" * digits))


def first_filled(*values: Column) -> Column:
    """The first value that is neither null, nor the empty text, nor the number zero, as text. The text '0' is a value."""

    def filled(v: Column) -> Column:
        shown = v.cast("string")
        return F.when((shown == "") | ((F.typeof(v) != "string") & (shown.try_cast("double") == 0)), None).otherwise(shown)

    return F.coalesce(*(filled(v) for v in values[:-1]), values[-1].cast("string"))


def votes(text: Column, lenient: bool = False) -> Column:
    """A vote count from text: empty and null are 0; other text fails, or is null when lenient."""
    filled = F.coalesce(F.nullif(text, F.lit("")), F.lit("0"))
    return filled.try_cast("int") if lenient else filled.cast("int")


def keys(text: Column) -> Column:
    """The names of a comma-separated list, trimmed and in lower case."""
    return F.transform(F.split(text, ","), lambda s: F.lower(F.trim(s)))
