"""One consistent form for text that looks the same (problem 7).

``fit_form`` joins code points and short strings that look alike into transitive classes by union-find, counts what
the corpus uses, and picks a representative of each class by frequency: one for Cyrillic words, one for Latin words,
one outside words. ``Form`` then rewrites texts with a multi-pattern automaton, leftmost and longest match first.

The form: Mongolian words have Cyrillic letters only; a letter and its mark are one character where Unicode has one;
full-width and half-width forms are normal; every space is U+0020 and every hyphen U+002D; nothing invisible is left,
except the vowel separator, variation selectors and joiners inside a word of Mongolian script, where they are
orthography. Words with a Latin letter that has no Cyrillic look-alike are Latin words. A word of look-alikes only is
Mongolian, unless the corpus uses its Latin spelling more often than the Cyrillic one, and at least 20 times. The rule
looks at the word's own counts only, whatever the size of the corpus. It needs some number of uses: a seldom word that is
never met in Cyrillic letters is mostly a Mongolian one whose few copies all have look-alikes.

Null stays null, the empty text stays empty; a text without letters is rewritten like any other. Letter case,
quotation marks, dashes, runs of plain spaces and marks without a composed letter are left alone.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Collection, Iterable, Iterator
from functools import lru_cache, partial, reduce

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clipsieve.llm.base import stored, table
from clipsieve.operators.tables import exists

# A Cyrillic letter and the letters of other alphabets, or older Cyrillic ones, that look like it.
LOOKALIKES = {
    "а": "a",
    "е": "e",
    "о": "oοօ",
    "р": "pρ",
    "с": "cϲ",
    "у": "y",
    "х": "xχ",
    "ө": "ɵѳ",
    "А": "AΑ",
    "В": "BΒ",
    "Е": "EΕ",
    "К": "KΚ",
    "М": "MΜ",
    "Н": "HΗ",
    "О": "OΟ",
    "Р": "PΡ",
    "С": "CϹ",
    "Т": "TΤ",
    "Х": "XΧ",
    "Ү": "YΥ",
    "Ө": "ƟѲ",
}
# Hyphens (not dashes), and what shows nothing although it isn't in the category of format characters.
HYPHENS = "-‐‑⁃﹣－"
UNSEEN = "͏ᅟᅠ឴឵ㅤﾠ"
WORD_OF_SCRIPT = "᠋᠌᠍᠎᠏‌‍"

LEAST_USES = 20
#: Up to so many Latin words of look-alikes go to the executors with the rules; beyond, they are joined to the texts.
BROADCAST_WORDS = 100_000
#: A text without any of these, which are all but plain punctuation, digits and Mongolian letters, is in the form already.
UNUSUAL = r"[\x00-\x1FA-Za-z\x7F-\xAA\xAC-\xBA\xBC-\x{0400}\x{0402}-\x{040F}\x{0450}\x{0452}-\x{04AD}\x{04B0}-\x{04E7}\x{04EA}-\x{10FFFF}]"

_WORD = regex.compile(r"[\p{L}\p{M}]+")
_ODD = regex.compile(r"[^\x20-\x7Eа-яА-ЯёЁөӨүҮ«»]|[A-Za-z]")


class Union:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: str, y: str) -> None:
        self.parent[self.find(x)] = self.find(y)

    def classes(self) -> list[list[str]]:
        found = defaultdict(list)
        for x in self.parent:
            found[self.find(x)].append(x)
        return [sorted(v) for v in found.values()]


def script(x: str) -> str:
    """Of a string's first character: cyrillic, latin, or other."""
    name = unicodedata.name(x[0], "") if x else ""
    return "cyrillic" if name.startswith("CYRILLIC") else "latin" if name.startswith("LATIN") else "other"


@lru_cache(maxsize=1)
def _widths() -> dict[str, str]:
    """Full-width, half-width and no-break forms with their normal form, and every space with the plain one."""
    found = {}
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        kind = unicodedata.decomposition(c).split(" ")[0]
        if kind in ("<wide>", "<narrow>"):
            found[c] = unicodedata.normalize("NFKC", c)
        elif unicodedata.category(c) in ("Zs", "Zl", "Zp") or c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85":
            found[c] = " "
    return found | dict.fromkeys(HYPHENS, "-")


@lru_cache(maxsize=1)
def _unseen() -> frozenset[str]:
    """Characters that show nothing: format characters, variation selectors, controls that aren't spaces, fillers."""
    def is_unseen(c: str) -> bool:
        kind, code = unicodedata.category(c), ord(c)
        return kind in ("Cf", "Cc") or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or 0x180B <= code <= 0x180F or c in UNSEEN

    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if is_unseen(c)) - _widths().keys()


def look_alike_classes() -> list[list[str]]:
    """Transitive classes over code points and strings: letters that look alike, and composed letters with all their spellings."""
    union = Union()
    for letter, others in LOOKALIKES.items():
        for other in others:
            union.join(letter, other)
    base = {x: group for group in union.classes() for x in group}
    for code in range(0x00C0, 0x0530):
        c = chr(code)
        apart = unicodedata.normalize("NFD", c)
        if len(apart) < 2:
            continue
        union.join(c, apart)
        for other in base.get(apart[0], ()):
            if script(c) == "cyrillic":
                union.join(c, other + apart[1:])
                union.join(c, unicodedata.normalize("NFC", other + apart[1:]))
    return union.classes()


class Form:
    """The rewriting rules; small, and sent to the executors with the function that uses them."""

    def __init__(self, counts: dict[str, int] | None = None, latin_words: Iterable[str] = ()) -> None:
        counts = counts or {}
        often = lambda x: min(counts.get(c, 0) for c in x)
        self.classes, self.cyrillic, self.latin = [], {}, {}
        for members in look_alike_classes():
            chosen = {}
            for kind in ("cyrillic", "latin"):
                composed = [x for x in members if len(x) == 1 and script(x) == kind]
                # the most frequent one; without any count, the one named first above
                if composed:
                    chosen[kind] = max(composed, key=lambda x: (often(x), x in LOOKALIKES, -ord(x)))
            self.classes.append((members, chosen.get("cyrillic"), chosen.get("latin")))
            for x in members:
                if (to := chosen.get("cyrillic")) and to != x:
                    self.cyrillic[x] = to
                if (to := chosen.get("latin")) and to != x and script(x) != "latin":
                    self.latin[x] = to
        self.latin_words = frozenset(latin_words)
        #: (word) where the Latin words are too many to be held here.
        self.latin_table: DataFrame | None = None
        self._ready = False

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ready": False, "latin_table": None, "_general": None, "_by_script": None}

    def _prepare(self) -> None:
        def automaton(rules: dict[str, str]) -> ahocorasick.Automaton:
            made = ahocorasick.Automaton()
            for x, to in rules.items():
                made.add_word(x, (len(x), to))
            made.make_automaton()
            return made

        self._general = automaton({x: to for x, to in _widths().items() if x != to} | dict.fromkeys(_unseen(), ""))
        self._by_script = {"cyrillic": automaton(self.cyrillic), "latin": automaton(self.latin)}
        alike = {c for members, to, _ in self.classes if to for x in members for c in x}
        self._alike = frozenset(c for c in alike if script(c) != "cyrillic" or c in self.cyrillic)
        self._marks = frozenset(c for c in alike if unicodedata.combining(c))
        self._cyrillic_alike = frozenset(x for x in self.latin if script(x) == "cyrillic")
        self._ready = True

    @staticmethod
    def _rewrite(text: str, automaton: ahocorasick.Automaton) -> str:
        """Leftmost match first, of those at one place the longest."""
        best: dict[int, tuple[int, str]] = {}
        for end, (length, to) in automaton.iter(text):
            start = end - length + 1
            if start not in best or best[start][0] < length:
                best[start] = length, to
        if not best:
            return text
        out, at = [], 0
        for start in sorted(best):
            if start >= at:
                out += text[at:start], best[start][1]
                at = start + best[start][0]
        return "".join(out) + text[at:]

    def _kind(self, word: str) -> str:
        """cyrillic, latin, none, or alike: a word of nothing but look-alikes, not all of them Cyrillic letters."""
        scripts = {script(c) for c in word if not unicodedata.combining(c)}
        if scripts == {"cyrillic"}:
            return "cyrillic"
        if any(script(c) == "cyrillic" and c not in self._cyrillic_alike for c in word):
            return "cyrillic"
        if all(c in self._alike or c in self._cyrillic_alike or unicodedata.combining(c) for c in word):
            return "alike"
        return "latin" if "latin" in scripts else "none"

    def _word(self, match: regex.Match, latin_words: Collection[str] = ()) -> str:
        word = match[0]
        if word.isascii() and not self._alike.issuperset(word):
            return word
        kind = self._kind(word)
        if kind == "alike":
            kind = "latin" if word in self.latin_words or word in latin_words else "cyrillic"
        if kind == "none":
            return word
        apart = unicodedata.normalize("NFD", word) if kind == "cyrillic" and not word.isascii() else word
        return unicodedata.normalize("NFC", self._rewrite(apart, self._by_script[kind]))

    def _clean(self, text: str) -> str:
        """Widths, spaces and hyphens made normal, and invisible characters taken out."""
        if regex.search(r"\p{Mongolian}", text):
            # inside a word of Mongolian script its own invisible characters are orthography
            pieces = regex.split(rf"(?<=\p{{Mongolian}})([{WORD_OF_SCRIPT}]+)(?=\p{{Mongolian}})", text)
            return "".join(x if i % 2 else self._rewrite(x, self._general) for i, x in enumerate(pieces))
        return self._rewrite(text, self._general)

    def __call__(self, text: str, latin_words: Collection[str] = ()) -> str:
        """``text`` in the form; ``latin_words`` are words of look-alikes that are Latin, beside those of the rules."""
        if not self._ready:
            self._prepare()
        word = partial(self._word, latin_words=latin_words) if latin_words else self._word
        return unicodedata.normalize("NFC", _WORD.sub(word, self._clean(text)))

    def candidates(self, text: str) -> Iterator[str]:
        """Words of look-alikes only that aren't in Cyrillic letters, cleaned."""
        if not self._ready:
            self._prepare()
        for word in _WORD.findall(self._clean(text)):
            if not regex.search(r"\p{Cyrillic}", word) and self._kind(word) == "alike":
                yield word


def normal_form(text: Column, form: Form) -> Column:
    """``text`` in the consistent form. Only texts with a character outside the plain ones reach Python, in Arrow batches."""

    @F.arrow_udf(StringType())
    def rewritten(batch: pa.Array) -> pa.Array:
        return pa.array([None if t is None else form(t) for t in batch.to_pylist()], pa.string())

    odd = text.rlike(UNUSUAL)
    return F.when(odd, rewritten(F.when(odd, text))).otherwise(text)


def _words_asked(form: Form):
    """The words of each text that only the corpus can tell the script of."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t, w) for t in batch.column(0).to_pylist() for w in set(form.candidates(t))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["_text", "word"])

    return asked


def in_form(rows: DataFrame, text: str, form: Form, to: str) -> DataFrame:
    """``rows`` with column ``text`` in the consistent form as column ``to``."""
    if form.latin_table is None:
        return rows.withColumn(to, normal_form(F.col(text), form))
    odd = F.coalesce(F.col(text).rlike(UNUSUAL), F.lit(False))
    some = rows.filter(odd)
    asked = some.select(text).distinct().mapInArrow(_words_asked(form), "_text string, word string")
    latin = asked.join(form.latin_table, "word").groupBy("_text").agg(F.collect_list("word").alias("_latin"))

    @F.arrow_udf(StringType())
    def rewritten(texts: pa.Array, words: pa.Array) -> pa.Array:
        return pa.array([form(t, w or ()) for t, w in zip(texts.to_pylist(), words.to_pylist(), strict=True)], pa.string())

    changed = some.join(latin, F.col(text) == F.col("_text"), "left").withColumn("_form", rewritten(F.col(text), F.col("_latin")))
    kept = [c for c in rows.columns if c != to]
    return rows.filter(~odd).select(*kept, F.col(text).alias(to)).unionByName(changed.select(*kept, F.col("_form").alias(to)))


def _usage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each code point occurs, and words of look-alikes only: w in other than Cyrillic letters, y in Cyrillic ones."""
    form = Form()
    cyrillic = {x for members, _, _ in form.classes for x in members if len(x) == 1 and script(x) == "cyrillic"}
    alike = cyrillic | {c for members, _, _ in form.classes for x in members for c in x if unicodedata.combining(c)}
    for batch in batches:
        texts = [t for t in batch.column(0).to_pylist() if t]
        words: Counter[str] = Counter()
        twins: Counter[str] = Counter()
        for t in texts:
            if _ODD.search(t):
                words.update(form.candidates(t))
        joined = " ".join(texts)
        for piece, n in Counter(joined.split()).items():
            for w in _WORD.findall(piece):
                if alike.issuperset(w):
                    twins[w] += n
        seen, n = np.unique(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), return_counts=True)
        codes = [("c", chr(c), n) for c, n in zip(seen.tolist(), n.tolist(), strict=True) if not 0xD800 <= c < 0xE000]
        rows = codes + [("w", w, n) for w, n in words.items()] + [("y", w, n) for w, n in twins.items()]
        kinds = pa.string(), pa.string(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["kind", "item", "n"])


def _twins(form: Form):
    """Words of look-alikes, each with the same word in Cyrillic letters."""

    def twins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [form(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), batch.column(1)], names=["word", "twin", "n"])

    return twins


def fit_form(*texts: DataFrame) -> Form:
    """Rules fitted to one-column tables of text: all of them are counted.

    What reaches the driver is bounded: a count for each code point, and at most ``BROADCAST_WORDS`` Latin words of
    look-alikes; more of them stay a table, which ``in_form`` joins to the texts.
    """
    column = texts[0]
    for t in texts[1:]:
        column = column.union(t)
    usage = stored(column.mapInArrow(_usage, "kind string, item string, n long").groupBy("kind", "item").agg(F.sum("n").alias("n")))
    codes = {r.item: r.n for r in usage.filter("kind = 'c'").collect()}
    often = usage.filter((F.col("kind") == "w") & (F.col("n") >= LEAST_USES)).select("item", "n")
    if not often.limit(1).count():
        return Form(codes)
    pairs = often.mapInArrow(_twins(Form(codes)), "word string, twin string, n long")
    cyrillic = usage.filter("kind = 'y'").select(F.col("item").alias("twin"), F.col("n").alias("uses"))
    latin = stored(pairs.join(cyrillic.hint("merge"), "twin", "left").filter(F.col("n") > F.coalesce("uses", F.lit(0))).select("word"))
    if latin.count() <= BROADCAST_WORDS:
        return Form(codes, [r.word for r in latin.collect()])
    form = Form(codes)
    form.latin_table = latin
    return form


# The fields of problem 7, with the key of their table.
FIELDS = [
    ("common_voice", "sentence", "row_id"),
    ("common_voice", "asr_transcript", "row_id"),
    ("worldspeech", "human_transcript", "ws_id"),
    ("fleurs", "raw_transcription", "fl_id"),
]


def fields(spark: SparkSession, sf_dir: str, named: list[tuple[str, str, str]] = FIELDS) -> DataFrame:
    """All values of the four fields: table_name, column_name, row_key, text."""
    parts = [
        table(spark, sf_dir, t).select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.col(k).alias("row_key"), F.col(c).alias("text"))
        for t, c, k in named
    ]
    return reduce(DataFrame.unionByName, parts)


def corpus_form(spark: SparkSession, sf_dir: str) -> Form:
    """The form of problem 7 for operators on common_voice: fitted to all four fields, of those tables that are there."""
    there = [x for x in FIELDS if x[0] == "common_voice" or exists(spark, f"{sf_dir}/{x[0]}.parquet")]
    return fit_form(fields(spark, sf_dir, there).select("text"))


def p7_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the four fields in the consistent form."""
    found = fields(spark, sf_dir)
    form = fit_form(found.select("text"))
    return in_form(found, "text", form, "text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are not in the consistent form."""
    found = fields(spark, sf_dir)
    form = fit_form(found.select("text"))
    changed = in_form(found.filter(F.col("text").rlike(UNUSUAL)), "text", form, "form")
    return changed.filter(F.col("form") != F.col("text")).select("table_name", "column_name", "row_key")


def p7_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The look-alike classes with the representatives chosen in this corpus."""
    form = fit_form(fields(spark, sf_dir).select("text"))
    rows = [(x, cyrillic, latin) for members, cyrillic, latin in form.classes for x in members]
    return spark.createDataFrame(rows, "member string, cyrillic string, latin string")
