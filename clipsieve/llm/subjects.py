"""Subject areas of documents, by label propagation over a verified graph of similar documents (problem 10).

Documents are the nodes. People's labels are the seeds. A hop has three steps. Terms that are characteristic of one
subject are found from the documents labelled so far: enough of a term's labelled documents have the subject, and more
than chance would give. They are the rare terms through which documents are sought, so common words, words of several
subjects and one-off words lead nowhere. Every other document that has a subject's label and shares terms with a document is
a candidate, and the pair is verified: the exact similarity of the two, the share of the subject's terms of the one with
fewer that both have, must reach LEAST_SIMILARITY. Over a verified edge the label goes to the document. In the
next hop every document passes on what it has received, except that trusted seeds (a subject named by two annotators or
more and not contradicted) keep their labels, in every hop and in the result. Hops go on until one changes at most one
in STILL labels: near the limits single documents may change back and forth for ever.

One edge is enough, so they are not all sought, which would be quadratic in the documents of a subject. First come each
subject's landmarks: LANDMARKS documents that have its label, out of a pool of POOL, trusted seeds first, so that they
together have its terms; edges to them are found in one pass. Documents that no landmark reaches go on to all others
that have the label, until one verifies the edge or all have been tried. So landmarks and pool save work, and decide nothing.

A document keeps every subject that fills enough of it: at least LEAST_DENSITY of its words and LEAST_SHARE of its
words of any subject. A section of a third of a document has about a third of its subject words, a passing mention
less than a fifth; the limits lie in the gaps that labelled documents show between the two.

Terms are words in lower case without the endings of Mongolian cases and plurals, Cyrillic letters written as Latin
ones, so that Mongolian in either alphabet has the same terms.

Defined cases: null, empty and letterless texts have no subject; labels of unknown subjects, null or blank, say "none";
repeated labels of one annotator count once; labels of unknown documents are ignored. Without labels no document has a
subject.
"""

from __future__ import annotations

import warnings
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipsieve.llm.base import key_of, stored, table
from clipsieve.llm.tokens import portions

#: Landmarks of a subject, and how many of them share a number.
LANDMARKS, LANES = 32, 4
#: Documents of a subject out of which they are chosen, and how many of them shall have each term.
POOL, COVERED = 500, 3
LEAST_SIMILARITY = 0.25
#: What no landmark reaches is compared with about so many labelled documents, then with GROWTH times as many, up to all.
TRIED, GROWTH = 200, 8
#: Labels settle after some four hops; a run that hasn't by then warns.
MOST_HOPS = 50
#: Labels have settled when a hop changes at most one in so many.
STILL = 1000
NONE, EVERY = "-", "*"
#: A verified term: documents with it, its share of one subject, and the evidence for it in nats.
LEAST_DOCUMENTS, LEAST_PURITY, LEAST_EVIDENCE = 3, 0.7, 4.0
LEAST_WORDS, LEAST_DENSITY, LEAST_SHARE = 2, 0.035, 0.23
#: Up to so many verified terms (some 100 bytes each) are broadcast; beyond, the join shuffles.
BROADCAST_TERMS = 100_000
#: Parts of a subject's documents in which landmarks are chosen before the whole.
PARTS = 64

# Latin spelling of Cyrillic letters, the usual one for Mongolian.
LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "ye", "ё": "yo", "ж": "j", "з": "z", "и": "i", "й": "i", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "ө": "u", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ү": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}
_LATIN = str.maketrans(LATIN)
_LETTERS = regex.compile(r"\p{L}+")
# Mongolian endings in Latin letters, of the plural and of cases, and the vowel that the soft sign may be.
ENDINGS = regex.compile(r"^(.{3,}?)(?:uud)?(?:iin|yn|iig|yg|aas|ees|oos|uus|aar|eer|oor|uur|tai|tei|toi|aa|ee|oo|uu|d|t|i)?$")


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """A word in Latin letters without its endings; at least three letters stay."""
    bare = ENDINGS.match(word)
    return bare[1] if bare else word


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in portions(batches, 1):
        terms, counts, ends, words = [], [], [0], []
        for t in texts:
            found = _LETTERS.findall(t.lower().translate(_LATIN)) if t else []
            stems = Counter()
            for w, n in Counter(found).items():
                stems[stem(w)] += n
            terms += stems.keys()
            counts += stems.values()
            ends.append(len(terms))
            words.append(len(found))
        offsets = pa.array(ends, pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(terms, pa.string())), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists, pa.array(words, pa.int32())], names=["doc_id", "terms", "counts", "words"])


def seeds(labels: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, subject, weight, trusted): each document's labels, weighted by the share of its annotators who gave them."""
    known = areas.select(key_of(F.col("subject")).alias("known")).filter("known is not null").distinct()
    said = labels.filter("doc_id is not null").select("doc_id", F.coalesce("annotator", F.lit("")).alias("annotator"), key_of(F.col("subject")).alias("subject"))
    said = said.join(known, F.col("subject") == F.col("known"), "left").select("doc_id", "annotator", F.coalesce("known", F.lit(NONE)).alias("subject")).distinct()
    votes = said.groupBy("doc_id", "subject").agg(F.count(F.lit(1)).alias("votes"))
    total = said.groupBy("doc_id").agg(F.count_distinct("annotator").alias("annotators"))
    # an annotator who names a second subject doesn't contradict the first
    agreed = votes.groupBy("doc_id").agg(((F.min("votes") >= 2) & (F.max((F.col("subject") == NONE).cast("int")) == 0)).alias("trusted"))
    return votes.join(total, "doc_id").join(agreed, "doc_id").select("doc_id", "subject", (F.col("votes") / F.col("annotators")).alias("weight"), "trusted")


def verified_terms(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(term, subject, purity) of terms that are characteristic of one subject, from labels (doc_id, subject, weight).

    A term's purity is the share of its labelled documents that have its most frequent subject, whatever else they are
    about.
    """
    every = F.struct(F.lit(EVERY).alias("subject"), F.lit(1.0).alias("weight"))
    own = labels.groupBy("doc_id").agg(F.collect_list(F.struct("subject", "weight")).alias("own"))  # at most all subjects
    labelled = documents.select("doc_id", "terms").join(own, "doc_id").withColumn("own", F.concat("own", F.array(every)))
    pairs = labelled.select("own", F.explode("terms").alias("term")).select("term", F.inline("own"))
    counts = pairs.groupBy("term", "subject").agg(F.sum("weight").alias("n"))
    is_every = F.col("subject") == EVERY
    best = counts.groupBy("term").agg(F.max(F.when(is_every, F.col("n"))).alias("documents"), F.max(F.when(~is_every, F.struct("n", "subject"))).alias("best"))
    # as many rows as subjects, so the window over all of them is small
    base = labelled.select(F.inline("own")).groupBy("subject").agg(F.sum("weight").alias("of"))
    every_n = F.max(F.when(is_every, F.col("of"))).over(Window.partitionBy(F.lit(1)))
    chance = base.withColumn("chance", F.col("of") / every_n).filter(~is_every).select("subject", "chance")
    purity = F.col("n") / F.col("documents")
    good = best.select("term", "documents", "best.n", "best.subject").filter((F.col("documents") >= LEAST_DOCUMENTS) & (F.col("subject") != NONE) & (purity >= LEAST_PURITY))
    return good.join(F.broadcast(chance), "subject").filter(F.col("n") * F.log(purity / F.col("chance")) >= LEAST_EVIDENCE).select("term", "subject", purity.alias("purity"))


def _met(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, words, count and the columns of ``terms``, for each term a document has."""
    few = terms.count() <= BROADCAST_TERMS
    each = documents.select("doc_id", "words", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("doc_id", "words", F.col("t.terms").alias("term"), F.col("t.counts").alias("count"))
    return each.join(F.broadcast(terms) if few else terms.hint("shuffle_hash"), "term")


def pool(labels: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, subject): POOL of the documents labelled (doc_id, subject) for each subject, trusted seeds first, then by hash."""
    sure = trusted.select("doc_id", "subject", F.lit(1).alias("_sure"))
    ranked = labels.filter(F.col("subject") != NONE).join(sure.hint("merge"), ["doc_id", "subject"], "left").select("doc_id", "subject", F.coalesce("_sure", F.lit(0)).alias("_sure"), F.xxhash64("doc_id").alias("_h"))
    # the first of each part of a subject, then of these: no subject is sorted in one task
    for keys in (["subject", F.pmod(F.col("_h"), F.lit(PARTS))], ["subject"]):
        first = Window.partitionBy(*keys).orderBy(F.desc("_sure"), "_h", "doc_id")
        ranked = ranked.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= POOL)
    return ranked.select("doc_id", "subject")


def covering(documents: dict[int, list[str]], most: int = LANDMARKS) -> list[int]:
    """Up to ``most`` of the documents that together have each term COVERED times, as far as may be; greedily the one with most terms that lack."""
    lack: dict[str, int] = {}
    for terms in documents.values():
        lack.update(dict.fromkeys(terms, COVERED))
    left, chosen = dict(sorted(documents.items())), []
    while left and len(chosen) < most:
        best = max(left, key=lambda d: sum(lack[t] > 0 for t in left[d]))
        if not any(lack[t] > 0 for t in left[best]):
            break
        for t in left.pop(best):
            lack[t] -= 1
        chosen.append(best)
    return chosen


def landmarks(documents: DataFrame, terms: DataFrame, some: DataFrame) -> DataFrame:
    """(doc_id, subject, mark): each subject's landmarks, numbered, out of its pool (doc_id, subject).

    Together they have the subject's terms, those of smaller languages too. The pools reach the driver: POOL rows of a
    subject, with their terms of it.
    """
    spark = documents.sparkSession
    held = _met(documents.join(F.broadcast(some.select("doc_id").distinct()), "doc_id", "left_semi"), terms)
    own: dict[str, dict[int, list[str]]] = {}
    for x in held.join(F.broadcast(some), ["doc_id", "subject"]).groupBy("doc_id", "subject").agg(F.collect_list("term").alias("own")).collect():
        own.setdefault(x.subject, {})[x.doc_id] = x.own
    chosen = [(d, subject, i) for subject, docs in own.items() for i, d in enumerate(covering(docs))]
    return spark.createDataFrame(chosen, "doc_id long, subject string, mark int")


def marked(documents: DataFrame, terms: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All terms with which landmarks have each, and (subject, sizes): how many terms of its subject each landmark has.

    A landmark has a lane of 16 bits in one of the numbers _m0, _m1 and so on, 1 if it has the term; so sums over a
    document's terms count the terms it shares with every landmark, in one pass.
    """
    # LANDMARKS documents to a subject
    some = documents.join(F.broadcast(marks.select("doc_id").distinct()), "doc_id", "left_semi")
    has = stored(_met(some, terms).select("doc_id", "term", "subject").join(F.broadcast(marks), ["doc_id", "subject"]))
    lanes = [F.expr(f"sum(if(mark div {LANES} = {i}, shiftleft(1L, cast(mark % {LANES} * 16 as int)), 0L))").alias(f"_m{i}") for i in range(LANDMARKS // LANES)]
    held = has.groupBy("term").agg(*lanes)
    sizes = has.groupBy("subject", "mark").agg(F.count(F.lit(1)).alias("n")).groupBy("subject").agg(F.map_from_entries(F.collect_list(F.struct("mark", "n"))).alias("_by_mark"))
    known = sizes.select("subject", *(F.coalesce(F.try_element_at("_by_mark", F.lit(k)), F.lit(0)).alias(f"_s{k}") for k in range(LANDMARKS)))
    return stored(terms.join(held.hint("merge"), "term", "left")), stored(known)


def partnered(documents: DataFrame, terms: DataFrame, asked: DataFrame, partners: DataFrame) -> DataFrame:
    """The rows (doc_id, subject, _own) of ``asked`` that a verified edge joins to any of ``partners``, in the same columns, labelled with the subject.

    Exact, in two steps. A partner with so few terms that one in common is enough settles all documents that have any
    of its terms, so two such partners are kept for each term. The others are compared with the partners that share a
    term, portion after portion, and only those that none has verified go on to the next; the last one ends the partners.
    """
    met = _met(documents, terms.select("term", "subject")).select("doc_id", "subject", "term")
    mine, theirs = (stored(met.join(rows.hint("merge"), ["doc_id", "subject"])) for rows in (asked, partners))
    short = theirs.filter(F.col("_own") * LEAST_SIMILARITY <= 1).groupBy("subject", "term").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    other = (F.col("_first") != F.col("doc_id")) | (F.col("_last") != F.col("doc_id"))
    done = stored(mine.join(short.hint("merge"), ["subject", "term"]).filter(other).select("doc_id", "subject", "_own").distinct())
    left = stored(mine.join(done.hint("merge"), ["doc_id", "subject"], "left_anti"))
    theirs = theirs.select(F.col("doc_id").alias("_partner"), "subject", "term", F.col("_own").alias("_theirs"))
    # portions of the partners by hash, out of 2^20
    every, upto = 1 << 20, 0
    step = max(1, every * TRIED // max(1, partners.count()))
    while upto < every and left.count():
        last, upto, step = upto, min(every, upto + step), step * GROWTH
        at = F.pmod(F.xxhash64("_partner"), F.lit(every))
        shared = left.join(theirs.filter((at >= last) & (at < upto)).hint("merge"), ["subject", "term"]).filter("doc_id != _partner")
        common = shared.groupBy("doc_id", "subject", "_own", "_partner", "_theirs").agg(F.count(F.lit(1)).alias("n"))
        found = stored(common.filter(F.col("n") >= F.least("_own", "_theirs") * LEAST_SIMILARITY).select("doc_id", "subject", "_own").distinct())
        done = done.unionByName(found)
        if upto < every:
            left = stored(left.join(found.hint("merge"), ["doc_id", "subject"], "left_anti"))
    return done


def reached(documents: DataFrame, terms: DataFrame, sizes: DataFrame, marks: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, words, subject, n): how many words of each subject a document has, for subjects of which a verified edge joins it to another document labelled (doc_id, subject)."""
    sums = [F.sum(f"_m{i}").alias(f"_m{i}") for i in range(LANDMARKS // LANES)]
    shared = _met(documents, terms).groupBy("doc_id", "words", "subject").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("_own"), *sums)
    # a row for each subject, and LANDMARKS for each
    edges = shared.join(F.broadcast(sizes), "subject", "left").join(F.broadcast(marks), ["doc_id", "subject"], "left")

    def verified(k: int) -> Column:
        common = F.shiftrightunsigned(f"_m{k // LANES}", k % LANES * 16).bitwiseAND(0xFFFF)
        return (common > 0) & (common >= F.least("_own", f"_s{k}") * LEAST_SIMILARITY) & (F.coalesce("mark", F.lit(-1)) != k)

    # three labelled documents or more have a term and its subject (verified_terms), so others share it where one in common is enough
    sure = reduce(lambda a, b: a | b, [verified(k) for k in range(LANDMARKS)], F.col("_own") * LEAST_SIMILARITY <= 1)
    rows = stored(edges.select("doc_id", "words", "subject", "n", "_own", F.coalesce(sure, F.lit(False)).alias("_sure")))
    scored, asked = rows.select("doc_id", "words", "subject", "n"), rows.filter("not _sure").select("doc_id", "subject", "_own")
    if not asked.count():
        return scored
    partners = stored(rows.select("doc_id", "subject", "_own").join(labels.select("doc_id", "subject").hint("merge"), ["doc_id", "subject"]))
    late = partnered(documents, terms, asked, partners).select("doc_id", "subject")
    return scored.join(asked.join(late.hint("merge"), ["doc_id", "subject"], "left_anti").hint("merge"), ["doc_id", "subject"], "left_anti")


def decide(scored: DataFrame) -> DataFrame:
    """(doc_id, subject, n) of the subjects a document is about."""
    total = scored.groupBy("doc_id").agg(F.sum("n").alias("topical"))
    enough = (F.col("n") >= F.least(F.lit(LEAST_WORDS), F.ceil(F.col("words") / 10))) & (F.col("n") >= F.col("words") * LEAST_DENSITY) & (F.col("n") >= F.col("topical") * LEAST_SHARE)
    return scored.join(total, "doc_id").filter(enough).select("doc_id", "subject", "n")


def settled(a: DataFrame, b: DataFrame) -> bool:
    """Whether at most one in STILL rows of two tables are in one of them only, whatever the rows' order and number."""
    each = a.withColumn("_in", F.lit(1)).unionByName(b.withColumn("_in", F.lit(2))).groupBy(*a.columns).agg(F.count_distinct("_in").alias("_tables"))
    changed, rows = each.agg(F.count_if(F.col("_tables") < 2), F.count(F.lit(1))).first()
    return changed * STILL <= rows


def clamped(found: DataFrame, trusted: DataFrame, documents: DataFrame, terms: DataFrame) -> DataFrame:
    """``found`` with the labels of ``trusted`` (doc_id, subject) that it lacks, of documents that have words."""
    lacking = trusted.join(found, ["doc_id", "subject"], "left_anti")
    labelled = documents.filter("words > 0").join(lacking.select("doc_id").distinct(), "doc_id", "left_semi")
    counted = _met(labelled, terms).groupBy("doc_id", "subject").agg(F.sum("count").alias("n"))
    added = lacking.join(labelled.select("doc_id").distinct(), "doc_id").join(counted, ["doc_id", "subject"], "left")
    return found.unionByName(added.select("doc_id", "subject", F.coalesce("n", F.lit(0)).alias("n")))


def subjects(documents: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, subject, n): the subjects of documents(doc_id, text)."""
    stems = stored(documents.select("doc_id", "text").filter("text is not null").mapInArrow(_stems, "doc_id long, terms array<string>, counts array<int>, words int"))
    given = stored(seeds(labels, areas))
    trusted = given.filter("trusted").select("doc_id", "subject", "weight")
    now = given.select("doc_id", "subject", "weight")
    terms = found = None
    for _ in range(MOST_HOPS):
        last_terms, terms = terms, stored(verified_terms(stems, now))
        # equal terms find equal subjects
        if last_terms is not None and settled(terms.select("term", "subject"), last_terms.select("term", "subject")):
            break
        marks = landmarks(stems, terms, stored(pool(now, trusted)))
        held, sizes = marked(stems, terms, marks)
        last, found = found, stored(decide(reached(stems, held, sizes, marks, now)))
        if last is not None and settled(found.select("doc_id", "subject"), last.select("doc_id", "subject")):
            break
        received = found.select("doc_id", "subject", F.lit(1.0).alias("weight"))
        empty = stems.select("doc_id").join(found.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", F.lit(NONE).alias("subject"), F.lit(1.0).alias("weight"))
        now = stored(received.unionByName(empty).join(trusted.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(trusted))
    else:
        warnings.warn(f"labels still changed after {MOST_HOPS} hops", RuntimeWarning, stacklevel=2)
    return clamped(found, trusted.select("doc_id", "subject"), stems, terms)


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects(table(spark, sf_dir, "documents"), table(spark, sf_dir, "doc_subject_labels"), table(spark, sf_dir, "subject_area"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each subject a document is about."""
    return _run(spark, sf_dir).select("doc_id", "subject")


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each subject, those without one as none."""
    found = _run(spark, sf_dir)
    every = table(spark, sf_dir, "documents").select("doc_id").join(found, "doc_id", "left")
    return every.groupBy(F.coalesce("subject", F.lit("none")).alias("subject")).agg(F.count(F.lit(1)).alias("n_documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_subject_words"))
