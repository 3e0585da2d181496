"""Language identification by Bayesian evidence fusion.

For each language l the score of a document is

    log P(l | host) + log P(declared | l) + log P(suffix | l) + trust * log P(text | l)

* Text: byte trigrams of the lower-cased letters, naive Bayes, fitted on a
  bounded sample of labelled rows: of each language the distinct rows of the
  smallest hashes, all of them or the share that makes about SAMPLE_DOCS, so
  that a rare language is fitted too. A label
  counts by its first part (``en-US`` is ``en``). Neighbouring trigrams depend
  on each other, so a long text counts as TRUST trigrams at most. A further
  class, ``und``, gives every trigram the same small probability; it wins on
  text that is like none of the languages.
* Host prior, smoothed by levels: host, then its domain (last two labels), then
  all documents. A level with few documents leans on the one above.
* Declared markup language and address suffix: P(value | l) from counts.

All counts are grouped aggregates over all documents, by the language that the
text alone suggests. The class ``und`` has a fixed small prior, and any
declared language or suffix is to it as likely as in all documents. They are joined as tables, whose sizes Spark checks before
it broadcasts any.

A document is accepted if its best class is a language and has a posterior of
at least ACCEPT, and there is any evidence: a trigram in the text or a known
declared language.

Edge rows: a null or empty text is no evidence, and so is a null or unknown
declared language, host or suffix. Without any evidence the language is
``und`` and the row is not accepted. The classes are the languages (two or three
letters) that LEAST_ROWS rows or more are labelled with, so at most some 18,000, each
256 KB in a task's model; one with fewer rows can't be fitted and isn't given.
Ties go to the language with more labelled rows, then to the first by name.
Repeated rows get the same answer. An empty table gives an empty result. An
input column named like a result column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import annotate, chunks, lean, prepare, store, text_buffer
from haulage.llm.op10_url_filter import document_of, host_of, path_of
from haulage.llm.registry import query, table

UNKNOWN = "und"
LEAST_ROWS = 1          # labelled rows that make a language a class, at least
SAMPLE_DOCS = 4_000     # labelled rows of each language that the text model is fitted on, some 2 % more or less
TRIGRAMS = 1 << 16      # buckets of the text model
TRUST = 200             # trigrams that a text counts as, at most
UND_LOG_P = -10.5       # log probability of a trigram in the class und
MIX = 0.3               # share of und in each language, so that a key or a number in a text costs little
SMOOTH = 20.0           # documents' worth of the level above in each level of a prior
UND_PRIOR = 1e-3        # prior of the class und, whatever the host
ACCEPT = 0.5

_MAP = np.full(256, 32, np.uint8)
_MAP[97:123] = np.arange(97, 123)
_MAP[65:91] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the byte trigrams of a chunk; runs of other bytes count as one space."""
    letter = _MAP[data]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    keep = np.ones(len(letter), bool)
    keep[1:] = (letter[1:] != 32) | (letter[:-1] != 32) | (row[1:] != row[:-1])
    letter, row = letter[keep].astype(np.uint32), row[keep]
    if len(letter) < 3:
        return row[:0], letter[:0].astype(np.int64)
    code = letter[:-2] << np.uint32(16) | letter[1:-1] << np.uint32(8) | letter[2:]
    same = row[:-2] == row[2:]
    return row[:-2][same], ((code[same] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def primary(tag: Column) -> Column:
    """First part of a language tag, in lower case: ``en`` of ``en-US``."""
    return F.regexp_extract(F.lower(tag), "^\\s*([^-_\\s]*)", 1)


def languages_of(docs: DataFrame, label_col: str, least: int = LEAST_ROWS) -> list[str]:
    """The languages that at least ``least`` rows are labelled with, most rows first."""
    tag = primary(F.col(f"`{label_col}`"))
    rows = (docs.select(tag.alias("l")).where(F.col("l").rlike("^[a-z]{2,3}$") & (F.col("l") != UNKNOWN))
            .groupBy("l").agg(F.count("*").alias("n")).where(F.col("n") >= least).collect())  # a row per language
    return [r.l for r in sorted(rows, key=lambda r: (-r.n, r.l))]


def fit(docs: DataFrame, label_col: str, id_col: str, text_col: str, languages: list[str],
        sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Log probabilities (trigram bucket, class), the class ``und`` last."""
    prepare(docs.sparkSession)
    if not languages:
        return np.full((TRIGRAMS, 1), UND_LOG_P, np.float32)
    label = F.array_position(F.array(*map(F.lit, languages)), primary(F.col(f"`{label_col}`"))) - 1
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), label.cast("int").alias("l"),
                       F.col(f"`{text_col}`").cast("string").alias("text")).where("l >= 0")
    rows = rows.select("l", "text", F.xxhash64("id", "l", "text").alias("h"))
    # repeated rows count once, or a few of them could fill a language's share
    hashes = store(rows.select("l", "h").distinct(), "language-labels")
    # hashes are spread evenly, so a bound on them takes the wanted share of a language; a row per language
    size = {r.l: r.n for r in hashes.groupBy("l").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros((TRIGRAMS, len(languages)))
    if size:
        share = [min(1.0, sample_docs / size.get(i, 1)) for i in range(len(languages))]
        bound = F.get(F.array(*[F.lit(min((1 << 63) - 1, int(s * 2 ** 64) - (1 << 63))).cast("long") for s in share]), F.col("l"))
        sample = rows.where(F.col("h") <= bound).dropDuplicates(["l", "h"])

        def count(batches):
            total = np.zeros((len(languages), TRIGRAMS), np.int64)
            for batch in batches:
                labels = batch.column(0).to_numpy()
                data, off = text_buffer(batch.column(1))
                for a, b in chunks(off):
                    row, gram = trigrams(data[off[a]:off[b]], off[a:b + 1] - off[a])
                    np.add.at(total, (labels[a:b][row], gram), 1)
            l, g = np.nonzero(total)
            if len(l):
                yield pa.RecordBatch.from_arrays([pa.array(l, pa.int32()), pa.array(g, pa.int32()), pa.array(total[l, g])],
                                                 names=["l", "g", "n"])
        # at most one row per class and bucket reaches the driver
        for r in (sample.select("l", "text").mapInArrow(lean(count), "l int, g int, n long")
                  .groupBy("l", "g").agg(F.sum("n").alias("n")).collect()):
            counts[r["g"], r["l"]] = r["n"]
    counts += 0.05
    model = np.full((TRIGRAMS, len(languages) + 1), UND_LOG_P, np.float32)
    model[:, :-1] = np.log((1 - MIX) * counts / counts.sum(axis=0) + MIX * np.exp(UND_LOG_P))
    return model


def text_scores(model: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Sum of log probabilities per row and class, scaled to TRUST trigrams at most."""
    data, off = text_buffer(texts)
    out = np.zeros((len(texts), model.shape[1]))
    for a, b in chunks(off):
        row, gram = trigrams(data[off[a]:off[b]], off[a:b + 1] - off[a])
        n = np.bincount(row, minlength=b - a)
        scale = np.minimum(1.0, TRUST / np.maximum(n, 1))
        for l in range(model.shape[1]):
            out[a:b, l] = np.bincount(row, weights=model[gram, l], minlength=b - a) * scale
    return out


def domain_of(host: Column) -> Column:
    return F.regexp_extract(host, "([^.]+\\.[^.]+)$", 1)


def suffix_of(host: Column) -> Column:
    return F.when(host.contains("."), F.substring_index(host, ".", -1))


def _counts(frame: DataFrame, classes: list[str]) -> DataFrame:
    """Documents per evidence value and language: (kind, key, n array)."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in ("host", "domain", "declared", "suffix")],
                    F.struct(F.lit("all").alias("kind"), F.lit("").alias("key")))
    rows = frame.where(F.col("text_best") < len(classes) - 1).select("text_best", F.explode(kinds).alias("e")).where("e.key is not null")
    sums = [F.sum((F.col("text_best") == i).cast("long")).cast("double") for i in range(len(classes) - 1)]
    return rows.groupBy("e.kind", "e.key").agg(F.array(*sums).alias("n"))


def _total(n: Column) -> Column:
    return F.aggregate(n, F.lit(0.0), lambda a, x: a + x)


def _smoothed(n: Column, above: Column) -> Column:
    return F.transform(F.arrays_zip(n.alias("n"), above.alias("p")), lambda x: (x["n"] + F.lit(SMOOTH) * x["p"]) / (_total(n) + F.lit(SMOOTH)))


def fuse(frame: DataFrame, classes: list[str]) -> DataFrame:
    """Adds language, confidence and accepted to rows with text_log_p, host, declared and suffix."""
    n_languages = len(classes) - 1
    best = lambda a: F.array_position(a, F.array_max(a)).cast("int") - 1
    has_text = F.exists("text_log_p", lambda x: x != 0)
    frame = store(frame.withColumn("text_best", F.when(has_text, best(F.col("text_log_p"))))
                  .withColumn("domain", F.when(domain_of(F.col("host")) != "", domain_of(F.col("host")))), "language-evidence")
    counts = store(_counts(frame, classes), "language-counts")
    of = lambda k, name: counts.where(F.col("kind") == k).select(F.col("key").alias(k), F.col("n").alias(name))
    # one row at most: the totals by class
    total = [r["n"] for r in counts.where("kind = 'all'").collect()] or [[0.0] * n_languages]
    whole = F.array(*[F.lit((n + SMOOTH / n_languages) / (sum(total[0]) + SMOOTH)) for n in total[0]])
    n_all = F.array(*map(F.lit, total[0]))
    rows = (frame.join(of("host", "n_host"), "host", "left").join(of("domain", "n_domain"), "domain", "left")
            .join(of("declared", "n_declared"), "declared", "left").join(of("suffix", "n_suffix"), "suffix", "left"))
    zero = F.array(*[F.lit(0.0)] * n_languages)
    prior = F.array_append(_smoothed(F.coalesce("n_host", zero), _smoothed(F.coalesce("n_domain", zero), whole)), UND_PRIOR)

    def likelihood(n: str) -> Column:
        """log P(value | class); 0 where there is no value."""
        some = F.transform(F.arrays_zip(F.col(n).alias("n"), n_all.alias("a")), lambda x: F.log((x["n"] + F.lit(0.5)) / (x["a"] + F.lit(SMOOTH))))
        overall = F.log((_total(F.col(n)) + F.lit(0.5)) / F.lit(sum(total[0]) + SMOOTH))
        return F.coalesce(F.array_append(some, overall), F.array_append(zero, 0.0))
    score = F.transform(F.arrays_zip(F.col("text_log_p").alias("t"), prior.alias("p"), likelihood("n_declared").alias("d"),
                                     likelihood("n_suffix").alias("s")), lambda x: x["t"] + F.log(x["p"]) + x["d"] + x["s"])
    rows = rows.withColumn("score", score)
    names = F.array(*map(F.lit, classes))
    known = F.coalesce(F.col("declared").isin(*classes[:-1]), F.lit(False)) | has_text
    top = F.array_max("score")
    confidence = F.lit(1.0) / F.aggregate("score", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    language = F.when(known, F.element_at(names, best(F.col("score")) + 1)).otherwise(F.lit(UNKNOWN))
    return (rows.withColumn("language", language).withColumn("confidence", F.when(known, confidence).otherwise(F.lit(0.0)))
            .withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("confidence") >= ACCEPT)))


def page_evidence(pages: DataFrame) -> DataFrame:
    """(doc_id, page_host, page_language) of each document shown by a page.

    A page's path is ``/<language>/<document>``; its markup names a language.
    Host and language each come from the page of smallest id that has one; a
    null id comes last.
    """
    number = document_of(path_of(F.col("url")))
    markup = F.lower(F.regexp_extract("html", "(?i)<html[^>]*\\blang\\s*=\\s*[\"']?([a-z]+)", 1))
    rows = pages.select(number.alias("doc_id"), "page_id", F.nullif(host_of(F.col("url")), F.lit("")).alias("host"),
                        F.nullif(markup, F.lit("")).alias("language")).where("doc_id is not null")
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", c)))
    return (rows.groupBy("doc_id").agg(first("host").alias("h"), first("language").alias("l"))
            .select("doc_id", F.col("h.host").alias("page_host"), F.col("l.language").alias("page_language")))


def identify(docs: DataFrame, pages: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, language, confidence, accepted.
    ``languages`` are the classes, those of the labels if not given.

    A document's declared language and host are those of its pages, where they
    have one, else its ``lang`` and ``source``. ``row_key`` is a hash of what
    the answer depends on.
    """
    languages = languages_of(docs, "lang") if languages is None else list(languages)
    if not languages:  # nothing to fit: every row is of no known language
        return docs.select(row_key(docs).alias("row_key"), "doc_id", F.lit(UNKNOWN).alias("language"), F.lit(0.0).alias("confidence"),
                           F.lit(False).alias("accepted"))
    model = fit(docs, "lang", "doc_id", "text", languages)
    classes = [*languages, UNKNOWN]

    def make():
        def score(texts):
            flat = text_scores(model, texts)
            return [pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * flat.shape[1], pa.int32()), pa.array(flat.reshape(-1)))]
        return score
    narrow = annotate(docs.select("doc_id", "lang", "source", "text", row_key(docs).alias("row_key")), "text", make,
                      "text_log_p array<double>", keep=["doc_id", "lang", "source", "row_key"])
    rows = (narrow.join(page_evidence(pages), "doc_id", "left")
            .select("row_key", "doc_id", "text_log_p", F.coalesce("page_host", "source").alias("host"),
                    F.coalesce("page_language", primary(F.col("lang"))).alias("declared"), suffix_of(F.col("page_host")).alias("suffix")))
    return fuse(rows, classes).select("row_key", "doc_id", "language", "confidence", "accepted")


def row_key(docs: DataFrame) -> Column:
    return F.xxhash64("doc_id", "lang", "source", "text")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))
    return out.select("doc_id", "language", F.round("confidence", 6).alias("confidence"), "accepted")
