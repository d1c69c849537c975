"""Licence notices in documents: a trained classifier of paragraphs, confirmed by templates. Built-in functions only.

A paragraph is a line, or several that a long sentence is wrapped over, without the signs of comments before them; such a
paragraph is judged as a whole and line by line. It is a sparse set of word n-grams, of one to three words, that hold at least one licence word; licence words
are those of the templates that are rare in the corpus outside notices, and the names of licences whatever their number. A multinomial logistic regression with a sparse penalty, trained
on the templates, parts of them and a bounded sample of other paragraphs, weighs the n-grams for each family and for
``unknown``. A paragraph without a licence word has no features and is unknown, so it is never joined with anything. A
temperature fitted on held-out rows calibrates the probabilities; a prediction counts as confirmed if the paragraph
shares enough of its n-grams with a template of the family.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doclake.llm.common import stored
from doclake.llm.license_texts import NAMES, OTHERS, STOPS, TEMPLATES

UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *TEMPLATES)
LONGEST = 3  # words of an n-gram


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _flagged(df: DataFrame, marked: list[str], name: str) -> DataFrame:
    """``df`` with ``flags``: which of its ``words`` are marked. Stored, so that what follows reads columns by place."""
    known = F.array(*map(F.lit, marked)) if marked else F.array().cast("array<string>")
    return stored(df.withColumn("flags", F.transform("words", lambda w: F.array_contains(known, w))), name)


def _grams() -> Column:
    """The distinct n-grams of the stored column ``words`` that hold a word flagged in ``flags``."""

    def gram(n: int):
        def at(word: Column, i: Column) -> Column:
            text, flag = word, F.get("flags", i)
            for k in range(1, n):
                text, flag = F.concat(text, F.lit(" "), F.get("words", i + k)), flag | F.coalesce(F.get("flags", i + k), F.lit(False))
            return F.when(flag, text)

        return at

    return F.array_distinct(F.filter(F.concat(*(F.transform("words", gram(n)) for n in range(1, LONGEST + 1))), lambda g: g.isNotNull()))


#: What stands between the lines of a wrapped paragraph, where a newline was.
_FOLD = "\x1f"


def _unwrapped(text: Column) -> Column:
    """``text`` with the newlines inside wrapped paragraphs replaced by ``_FOLD``, without comment signs and white space at line ends.

    A line goes on in the next one if it has six words or more, no sign that ends a sentence is its last character, and the
    next line is not blank.
    """
    bare = F.regexp_replace(text, r"(?dm)^[ \t]*+(?://++[/!]*+|/\*++!?|\*++/?|#++|--++|;++|%++|>++|<!--|(?i:rem|dnl)(?=[ \t]))[ \t]*+", "")
    bare = F.regexp_replace(bare, r"(?<![ \t\r])[ \t\r]++(?=\n)", "")
    return F.regexp_replace(bare, r"(?dm)^([ \t]*+(?:[^\s]++[ \t]++){5}[^\n]++)(?<![.!?:;])\n(?=[ \t]*+\S)", f"$1{_FOLD}")


def paragraphs(docs: DataFrame) -> DataFrame:
    """``(doc_id, mark, paragraph, line, text)`` of each paragraph of each document; the mark tells rows that share a doc_id apart.

    A paragraph of one line has ``line`` -1; one wrapped over more has a row as a whole, of line -1, and one for each line.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), F.posexplode(F.split(_unwrapped(text), "\n")).alias("paragraph", "whole")
    )
    lines = F.split("whole", _FOLD)
    units = F.when(F.size(lines) > 1, F.concat(F.array("whole"), lines)).otherwise(F.array("whole"))
    return whole.select("doc_id", "mark", "paragraph", F.posexplode(units).alias("line", "text")).withColumn("line", F.col("line") - 1)


@dataclass(frozen=True)
class LicenseModel:
    """Licence words, ``{n-gram: weights by family}``, biases and temperature; its size is that of the training data."""

    words: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float


def _training_rows() -> list[tuple[str, str, int]]:
    """``(family, text, fold)``: templates, their sentences and parts, alone and between other words."""
    rows = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = text.split()
            half = len(words) // 2
            forms = [text, text.upper(), f"Note: {text}", f"{text} Thank you.", f"Copyright (c) 2024 the authors. {text}"]
            if len(words) > 12:
                forms += [" ".join(words[:half]), " ".join(words[half:]), " ".join(words[: 2 * half - 2]), *(s for s in text.split(". ") if len(s.split()) > 6)]
            rows += [(family, form, i % 4) for i, form in enumerate(forms)]
    rows += [(UNKNOWN, form, i % 4) for i, text in enumerate(OTHERS * 3) for form in (text, f"{text} It was late.")]
    return rows


def _like_templates(shared: int = 3) -> Column:
    """Whether ``shared`` stretches of three words of the column ``words`` stand in templates."""
    texts = (re.findall("[a-z0-9]+", t.lower()) for group in TEMPLATES.values() for t in group)
    known = sorted({" ".join(w[i : i + 3]) for w in texts for i in range(len(w) - 2)})
    found = F.transform("words", lambda w, i: F.concat(w, F.lit(" "), F.get("words", i + 1), F.lit(" "), F.get("words", i + 2)))
    return F.size(F.array_intersect(found, F.array(*map(F.lit, known)))) >= shared


def train(docs: DataFrame, sample: int = 2_000, rare: float = 0.02, penalty: float = 0.0005) -> LicenseModel:
    """The model from the templates and at most ``sample`` paragraphs of the corpus, chosen by a hash, as ``unknown``.

    Paragraphs like a template, or with a fifth of licence words, are left out of the sample, for they may be notices. Template
    words in at least a share ``rare`` of the sample's different texts that name no licence and are not like a template are
    too common to be licence words, so notices do not strike their own words, however many there are; names are never struck.
    """
    spark: SparkSession = docs.sparkSession
    lines = paragraphs(docs).filter("trim(text) <> ''").select(F.xxhash64("doc_id", "mark", "paragraph", "line").alias("h"), "text")
    taken = lines.orderBy("h", "text").limit(sample).groupBy("text").agg(F.min("h").alias("h"))
    taken = stored(taken.withColumn("words", _words(F.col("text"))), "lines")
    rows = spark.createDataFrame(_training_rows(), "family string, text string, fold int").withColumn("words", _words(F.col("text")))
    names = F.array(*map(F.lit, sorted(NAMES)))
    prose = taken.filter(~_like_templates() & ~F.arrays_overlap("words", names))
    seen = prose.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    common = seen.filter(F.col("count") >= max(2.0, rare * prose.count())).select("word")
    terms = rows.filter(F.col("family") != UNKNOWN).select(F.explode("words").alias("word")).distinct().filter(~F.col("word").isin(*sorted(STOPS)))
    marked = sorted(r[0] for r in terms.join(common, "word", "left_anti").filter(F.char_length("word") > 1).collect())
    known = F.array(*map(F.lit, marked))
    share = F.size(F.filter("words", lambda w: F.array_contains(known, w))) / F.greatest(F.size("words"), F.lit(1))
    plain = taken.filter((share < 0.2) & ~_like_templates()).select(F.lit(UNKNOWN).alias("family"), "text", F.expr("cast(pmod(h, 4) as int)").alias("fold"), "words")
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    data = _flagged(rows.unionByName(plain).select(label.cast("int").alias("label"), "fold", "words").coalesce(1), marked, "training")
    data = data.select("label", "fold", _grams().alias("grams"))
    # Without n-grams nothing is learnt but that it is unknown, which needs no weights.
    found = data.filter("size(grams) > 0").collect()  # the templates' forms and what of the sample has licence words
    index: dict[str, int] = {}
    for r in found:
        for gram in r["grams"]:
            index.setdefault(gram, len(index))
    x = np.zeros((len(found), len(index)), np.float32)
    for i, r in enumerate(found):
        x[i, [index[g] for g in r["grams"]]] = 1
    y = np.array([int(r["label"]) for r in found])
    later = np.array([r["fold"] == 3 for r in found])
    raw = x[later] @ (part := fit(x[~later], y[~later], penalty))[0] + part[1]
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=lambda t: _loss(raw / t, y[later]))
    matrix, bias = fit(x, y, penalty)
    weights = {g: matrix[i].tolist() for g, i in index.items() if matrix[i].any()}
    return LicenseModel(marked, weights, bias.tolist(), temperature)


def _log_shares(raw: np.ndarray) -> np.ndarray:
    raw = raw - raw.max(axis=1, keepdims=True)
    return raw - np.log(np.exp(raw).sum(axis=1, keepdims=True))


def _balance(y: np.ndarray) -> np.ndarray:
    """Weights by which each family counts as much as the next, unknown as much as three."""
    each = 1 / np.maximum(np.bincount(y, minlength=len(FAMILIES)), 1)
    each[0] *= 3
    return each[y] / each[y].sum()


def _loss(raw: np.ndarray, y: np.ndarray) -> float:
    return float(-(_balance(y) * _log_shares(raw)[np.arange(len(y)), y]).sum())


def fit(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights ``(n-grams, families)`` and biases of a multinomial logistic regression with an absolute penalty on weights.

    Accelerated proximal gradient: a step against the slope, then every weight moved toward 0 by the penalty.
    """
    share, target = _balance(y), np.eye(len(FAMILIES))[y]
    held = (x * np.sqrt(share)[:, None]).astype(np.float64)
    v = np.ones(x.shape[1])
    for _ in range(30):
        v = held.T @ (held @ v)
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    rate = 1 / (norm / 2 + 0.5)
    w = look = np.zeros((x.shape[1], len(FAMILIES)))
    b = look_b = np.zeros(len(FAMILIES))
    pace = 1.0
    for _ in range(steps):
        gap = share[:, None] * (np.exp(_log_shares(x @ look + look_b)) - target)
        moved = look - rate * (x.T @ gap)
        new = np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty, 0)
        new_b = look_b - rate * gap.sum(axis=0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        look, look_b = new + (pace - 1) / faster * (new - w), new_b + (pace - 1) / faster * (new_b - b)
        w, b, pace = new, new_b, faster
    return w, b


def license_paragraphs(docs: DataFrame, model: LicenseModel, least: float = 0.5, alike: float = 0.5, shared: int = 3) -> DataFrame:
    """``(doc_id, mark, paragraph, line, family, probability, template_share, similar, confirmed)`` of paragraphs with a licence word.

    ``family`` is the most probable one, or ``unknown`` if that is unknown or below ``least``. ``template_share`` is the
    largest share of n-grams in common with a template of the family, of the smaller of the two sets; from ``alike`` on the
    prediction is ``confirmed`` (``similar`` are all families with such a template), if ``shared`` n-grams agree at least, or all of a template that has fewer. Every paragraph of every whole text is read; one without licence words gives no row, as do
    null and empty texts. Repeated rows give repeated results only if their doc_id or text differs.
    """
    spark = docs.sparkSession
    known = F.array(*map(F.lit, model.words)) if model.words else F.array().cast("array<string>")
    hits = paragraphs(docs).withColumn("words", _words(F.col("text"))).filter(F.arrays_overlap("words", known))
    hits = _flagged(hits.select("doc_id", "mark", "paragraph", "line", "words"), model.words, "hits")
    hits = hits.select("doc_id", "mark", "paragraph", "line", _grams().alias("grams"))
    hits = stored(hits.groupBy("doc_id", "mark", "paragraph", "line").agg(F.first("grams").alias("grams")), "paragraphs")
    table = spark.createDataFrame(list(model.weights.items()) or [("", [0.0] * len(FAMILIES))], "gram string, weights array<double>")
    each = hits.select("doc_id", "mark", "paragraph", "line", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    sums = each.join(F.broadcast(table), "gram", "left").groupBy("doc_id", "mark", "paragraph", "line").agg(
        F.first("n").alias("n"), *(F.sum(F.coalesce(F.col("weights")[k], F.lit(0.0))).alias(f"s{k}") for k in range(len(FAMILIES)))
    )
    raw = [(F.col(f"s{k}") + F.lit(float(b))) / model.temperature for k, b in enumerate(model.bias)]
    top = F.greatest(*raw)
    total = sum((F.exp(x - top) for x in raw[1:]), F.exp(raw[0] - top))
    best = F.array_max(F.array(*(F.struct(x.alias("raw"), F.lit(f).alias("family")) for x, f in zip(raw, FAMILIES, strict=True))))
    predicted = sums.select("doc_id", "mark", "paragraph", "line", "n", best["family"].alias("best"), (1 / total).alias("probability"))
    family = F.when(F.col("probability") >= least, F.col("best")).otherwise(UNKNOWN)
    predicted = predicted.withColumn("family", family).drop("best")

    texts = [(f, i, t) for f, group in TEMPLATES.items() for i, t in enumerate(group)]
    grams = spark.createDataFrame(texts, "family string, template int, text string").withColumn("words", _words(F.col("text"))).coalesce(1)
    grams = _flagged(grams, model.words, "templates").withColumn("grams", _grams())
    grams = grams.select("family", "template", F.size("grams").alias("m"), F.explode("grams").alias("gram"))
    common = each.join(F.broadcast(grams), "gram").groupBy("doc_id", "mark", "paragraph", "line", "family", "template").agg(
        (F.count("*") / F.least(F.first("n"), F.first("m"))).alias("share"), F.count("*").alias("common"), F.first("m").alias("m")
    ).filter(F.col("common") >= F.least(F.lit(shared), F.col("m")))
    nearest = common.groupBy("doc_id", "mark", "paragraph", "line").agg(
        *(F.coalesce(F.max(F.when(F.col("family") == f, F.col("share"))), F.lit(0.0)).alias(f"t{k}") for k, f in enumerate(FAMILIES))
    )
    same = reduce(and_, (predicted[c].eqNullSafe(nearest[c]) for c in ("doc_id", "mark", "paragraph", "line")))
    own = reduce(lambda rest, k: F.when(F.col("family") == FAMILIES[k], F.col(f"t{k}")).otherwise(rest), range(len(FAMILIES)), F.lit(0.0))
    close = F.array_compact(F.array(*(F.when(F.col(f"t{k}") >= alike, F.lit(f)) for k, f in enumerate(FAMILIES))))
    found = predicted.join(nearest, same, "left").select(
        *(predicted[c] for c in ("doc_id", "mark", "paragraph", "line", "family", "probability")),
        F.coalesce(own, F.lit(0.0)).alias("template_share"),
        close.alias("similar"),
    )
    return found.withColumn("confirmed", (F.col("family") != UNKNOWN) & (F.col("template_share") >= alike))


def license_documents(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """``(doc_id, families, n_confirmed, n_unconfirmed, n_unknown)`` of each row: the confirmed families, sorted, and counts.

    A wrapped paragraph counts once: confirmed if it is as a whole or one of its lines is, else of a family if one is. Beside
    the family of a confirmed whole stand those of its lines that are not like the whole's family too.
    ``n_unconfirmed`` counts paragraphs of a family that no template confirms, ``n_unknown`` those with licence words that
    the classifier calls unknown. Rows that share a doc_id are told apart by their text; repeated rows stay.
    """
    each = license_paragraphs(docs, model).groupBy("doc_id", "mark", "paragraph").agg(
        F.max(F.when((F.col("line") < 0) & F.col("confirmed"), F.col("family"))).alias("whole"),
        F.collect_set(F.when(F.col("confirmed"), F.struct("family", "similar"))).alias("lines"),
        F.max("confirmed").alias("confirmed"),
        F.max(F.col("family") != UNKNOWN).alias("known"),
    )
    counted = F.filter("lines", lambda u: F.col("whole").isNull() | (u["family"] == F.col("whole")) | ~F.array_contains(u["similar"], F.col("whole")))
    each = each.withColumn("families", F.array_distinct(F.transform(counted, lambda u: u["family"])))
    found = each.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("families")))).alias("families"),
        F.count_if(F.col("confirmed")).alias("n_confirmed"),
        F.count_if(~F.col("confirmed") & F.col("known")).alias("n_unconfirmed"),
        F.count_if(~F.col("known")).alias("n_unknown"),
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"))
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["_id"]) & (rows["mark"] == found["_mark"]), "left")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("n_confirmed", "n_unconfirmed", "n_unknown")]
    return joined.select("doc_id", F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"), *counts)
