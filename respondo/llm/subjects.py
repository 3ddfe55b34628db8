"""The subject areas of each document: complement naive Bayes, refined by expectation-maximisation over
unlabelled documents, with calibrated independent posteriors.

A document is a list of sentences or lines, cut at line ends and end marks, each a bag of hashed features (words, word pairs, Hangul
prefixes, Han and kana sequences) in the bucket range of the document's language; a long stretch without marks is cut by the boundary model of `sentences`. The weight of a
feature for a subject is the smoothed log odds of the feature within the subject against all others (the
complement), relative to the subject's share of its language, so that wording common to a language says
nothing. Labelled documents give the first counts; each round takes, for every unlabelled document, the
posterior of each of its features over the subjects and `none` under the document's own mixture, and adds
the soft counts, discounted, to those of the labels. Only the count table travels: its size is fixed by
the number of buckets, whatever the corpus. A document is about a subject if at least two of its sentences
are, so what decides is the evidence of its second strongest sentence: a logistic curve for each subject, fitted against labelled
documents (at most `MAX_LABELS`), maps it to a posterior of its own, and subjects of a posterior above one half are assigned."""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, spread
from .sentences import BoundaryModel, sentence_ends

#: Hash buckets of each language group, and of all.
RANGE = 1 << 15
#: Labelled documents the calibration is fitted on at most.
MAX_LABELS = 20_000
ROUNDS = 4
SMOOTHING = 1.0
#: Weight of the soft counts of unlabelled documents.
UNLABELLED = 0.3
#: Steps to a document's mixture, and the least weight of a feature that has a say in it.
STEPS, TELLING = 4, 0.5
#: The share of labels that is taken to be wrong when posteriors are calibrated.
WRONG = 0.05
#: How many labels' worth the belief weighs that a curve crosses one half where there is no evidence either way.
PRIOR = 4.0
#: Subjects above this posterior are assigned.
ASSIGNED = 0.5
#: Labelled documents up to which their votes are broadcast; beyond, they are joined by a shuffle.
BROADCAST_LABELS = 200_000
#: Documents whose features are weighed together.
_TOGETHER = 2048
#: Characters without an end mark after which the boundary model looks for more sentences.
_LONG = 90
_INVISIBLE = regex.compile(r"[\u00ad\u034f\u061c\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufeff]+")
_LINES = regex.compile(r"[^\n\r\x0b\x0c\x85\u2028\u2029]+")
_END = regex.compile(r"[.!?。।॥؟…♪~～]+[\"'”’」』)\]】]*")
_ENCLOSED = regex.compile(r"[\"“„「『(\[«《【‘'][^\"”“」』)\]»》】]*[.!?。…][^\"”“」』)\]»》】]*[\"”“」』)\]»》】’']")
_SHORT = regex.compile(r"(?:^|(?<=[\s(]))(?:\p{Lu}\p{L}{0,2}|\p{L}|\d{1,2})$")
_SURE = frozenset("。।॥؟♪")
NONE = "none"
_RUN = regex.compile(r"(?P<hangul>\p{Hangul}+)|(?P<sign>[\p{Han}\p{Hiragana}\p{Katakana}ー々]+)|(?P<word>[\p{L}\p{M}]+(?:['’-][\p{L}\p{M}]+)*)")
# Common words of languages in Latin script.
COMMON = {
    "en": "the of and to for is was with about i", "de": "der die das und für mich nicht bei ist wir zum", "es": "el la los las de que y con por para más",
    "fr": "le les des et pour est dans que qui une avec", "it": "il gli di che per con una non sono della", "pt": "o os do da que em para com não uma", "nl": "het een van en dat niet voor met ik",
}
_COMMON = {language: frozenset(words.split()) for language, words in COMMON.items()}
_SCRIPTS = {"ko": r"\p{Hangul}", "ja": r"[\p{Hiragana}\p{Katakana}]", "zh": r"\p{Han}", "th": r"\p{Thai}", "ar": r"\p{Arabic}", "hi": r"\p{Devanagari}", "ru": r"\p{Cyrillic}"}
_SCRIPT = {language: regex.compile(p) for language, p in _SCRIPTS.items()}
GROUPS = [*_SCRIPTS, *COMMON, "other"]
BUCKETS = RANGE * len(GROUPS)
_LATIN = regex.compile(r"\p{Latin}")
_STATED = {name: i for i, name in enumerate(GROUPS) if name != "other"}


def group_of(text: str, lang: str | None = None) -> int:
    """The number of the language group of a text: the stated language if it is one of them, else by script, and
    for Latin script by its common words."""
    stated = (lang or "").strip().lower()
    if stated in _STATED:
        return _STATED[stated]
    counts = {language: len(p.findall(text)) for language, p in _SCRIPT.items()}
    if counts["ja"] * 6 > counts["zh"]:
        counts["ja"], counts["zh"] = counts["ja"] + counts["zh"] if counts["ja"] else 0, 0 if counts["ja"] else counts["zh"]
    best = max(counts, key=counts.get)
    if counts[best] * 2.5 >= max(1, len(_LATIN.findall(text))):
        return GROUPS.index(best)
    words = regex.findall(r"\p{L}+", text.casefold())
    hits = {language: sum(w in common for w in words) for language, common in _COMMON.items()}
    best = max(hits, key=hits.get)
    return GROUPS.index(best if hits[best] else "other")


def units(model: BoundaryModel, text: str) -> list[str]:
    """The sentences and lines of a text: cut at line ends, at marks that only end sentences and at others before white space
    and no small letter, but not after a short capital word as in Dr. or No.; lines with marks inside quotations or
    brackets and what is still long are cut by the boundary model."""
    out = []
    for line in _LINES.findall(text):
        if _ENCLOSED.search(line):
            out += _decoded(model, line)
            continue
        begin = 0
        for m in _END.finditer(line):
            end, sign = m.end(), m.group()
            following = line[end : end + 1]
            if _SURE.isdisjoint(sign) and following:
                if following.isspace():
                    if line[end + 1 : end + 2].islower() or (sign == "." and _SHORT.search(line, begin, m.start())):
                        continue
                elif following < "\u2e80" or sign[0] == ".":
                    continue
            out += [line[begin:end]] if end - begin <= _LONG else _decoded(model, line[begin:end])
            begin = end
        if begin < len(line):
            out += [line[begin:]] if len(line) - begin <= _LONG else _decoded(model, line[begin:])
    return out


def _decoded(model: BoundaryModel, line: str) -> list[str]:
    ends = sentence_ends(model, line)
    return [line[a:b] for a, b in zip([0, *ends], ends)]


#: Hashes of words and of their pairs that a worker remembers, then starts afresh.
_REMEMBERED = 1 << 18
_seen: dict[tuple[int, str, str, str], tuple[int, ...]] = {}


def _hashes(group: int, kind: str, before: str, text: str) -> tuple[int, ...]:
    found = []
    if kind == "hangul":
        found = [text[:n] for n in range(2, min(len(text), 6) + 1)]
        if before:
            found.append(f"{before} {text[:2]}")
    elif kind == "sign":
        found = [text[i : i + n] for n in (2, 3, 4) for i in range(len(text) - n + 1)]
    else:
        found = [text, f"{before} {text}"] if before else [text]
    return tuple({group * RANGE + zlib.crc32(f.encode()) % RANGE for f in found})


def features(sentence: str, group: int) -> list[int]:
    """The distinct hashed features of a sentence, sorted, in the bucket range of its group."""
    found: set[int] = set()
    before = ""
    for m in _RUN.finditer(sentence.casefold()):
        text, kind = m.group(), m.lastgroup
        key = (group, kind, "" if kind == "sign" else before, text)
        hashes = _seen.get(key)
        if hashes is None:
            if len(_seen) > _REMEMBERED:
                _seen.clear()
            hashes = _seen[key] = _hashes(group, kind, before, text)
        found.update(hashes)
        before = text
    return sorted(found)


def featurise(documents: DataFrame, key: str, text: str, model: BoundaryModel, lang: str | None = None) -> DataFrame:
    """(key, sentences array<array<int>>, found array<int>, n array<int>): the features of each sentence or
    line, and those of the whole document with their numbers; empty for null and blank texts."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("key", documents.schema[key].dataType), T.StructField("sentences", T.ArrayType(T.ArrayType(T.IntegerType()))), *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("found", "n")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = shared.value
        for batch in batches:
            out = []
            for value, stated in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                plain = unicodedata.normalize("NFKC", _INVISIBLE.sub("", value)) if value else ""
                group = group_of(plain, stated)
                found = [features(u, group) for u in units(decode, plain)]
                out.append([u for u in found if u])
            whole = [Counter(f for u in found for f in u) for found in out]
            lists = [pa.array(x, pa.list_(pa.int32())) for x in ([list(c) for c in whole], [list(c.values()) for c in whole])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.list_(pa.int32()))), *lists], names=["key", "sentences", "found", "n"])

    stated = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    return spread(documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), stated.alias("lang"))).mapInArrow(run, schema)


def weights(counts: np.ndarray) -> np.ndarray:
    """Complement log odds of each feature (rows) for each class (columns), relative to the class's share of
    the feature's language group and shrunk towards 0 for rare features."""
    blocks = counts.reshape(len(GROUPS), RANGE, -1)
    share = (blocks.sum(1, keepdims=True) + 1.0) / (blocks.sum((1, 2), keepdims=True) + counts.shape[1])
    total = blocks.sum(2, keepdims=True)
    w = np.log((blocks + SMOOTHING * share) / (total - blocks + SMOOTHING * (1 - share))) - np.log(share / (1 - share))
    return np.where(total > 0, w, 0).reshape(counts.shape).astype(np.float32)


class Weights:
    """Weights as they travel: only features that were seen, in half precision; whole again on first use."""

    def __init__(self, w: np.ndarray):
        self.rows = np.flatnonzero(w.any(1)).astype(np.int32)
        self.values = w[self.rows].astype(np.float16)
        self.classes = w.shape[1]
        self._whole = self._likely = self._telling = None

    def __getstate__(self):
        return self.rows, self.values, self.classes

    def __setstate__(self, state):
        self.rows, self.values, self.classes = state
        self._whole = self._likely = self._telling = None

    @property
    def whole(self) -> np.ndarray:
        if self._whole is None:
            self._whole = np.zeros((BUCKETS, self.classes), np.float32)
            self._whole[self.rows] = self.values
        return self._whole

    @property
    def likely(self) -> np.ndarray:
        """The odds of each feature and class."""
        if self._likely is None:
            self._likely = np.exp(np.clip(self.whole, -6, 6))
        return self._likely

    @property
    def telling(self) -> np.ndarray:
        """The say of each feature in the mixture of its document; 0 for those that tell little."""
        if self._telling is None:
            top = self.whole.max(1)
            self._telling = np.where(top >= TELLING, top, 0)
        return self._telling


def _soft_counts(w: Weights, found: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each feature of some documents over the classes, under the mixture of its document that the
    document's telling features settle. `found` and `n` are the documents' features end to end, `sizes` how many each
    document has, none of them 0."""
    likely, telling = w.likely[found], n * w.telling[found]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    some = np.flatnonzero(telling)
    part, weight, whose = likely[some], telling[some][:, None], owner[some]
    starts = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1]]) if len(some) else some
    heads = whose[starts]
    mixture = np.full((len(sizes), w.classes), 1.0 / w.classes, np.float32)
    for _ in range(STEPS if len(some) else 0):
        p = part * mixture[whose]
        p *= weight / p.sum(1, keepdims=True)
        mixture[heads] = np.add.reduceat(p, starts, axis=0) + 0.3
        mixture[heads] /= mixture[heads].sum(1, keepdims=True)
    likely *= mixture[owner]
    likely *= (n / likely.sum(1))[:, None]
    return likely


def _count(df: DataFrame, classes: int, shared) -> np.ndarray:
    """Counts of all features by class, summed per partition before they are shuffled: by the votes of
    labelled documents if `shared` is None, else soft counts of the others under the weights in it."""
    schema = T.StructType([T.StructField("f", T.IntegerType()), T.StructField("c", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((BUCKETS, classes))
        for batch in batches:
            for a in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(a, _TOGETHER)
                sizes = part.column(0).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                found = part.column(0).flatten().to_numpy(zero_copy_only=False)
                n = 1 + np.log(part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32))  # repetitions say less and less
                if shared is None:
                    votes = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, classes)
                    soft = np.repeat(votes / votes.sum(1, keepdims=True), sizes, axis=0) * n[:, None]
                else:
                    soft = _soft_counts(shared.value, found, n, sizes)
                buckets, place = np.unique(found, return_inverse=True)
                for c in range(classes):
                    table[buckets, c] += np.bincount(place, soft[:, c], len(buckets))
        rows = np.flatnonzero(table.any(1))
        for i in range(0, len(rows), 10_000):
            part = rows[i : i + 10_000]
            flat = pa.array(table[part].ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, classes), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), lists], names=["f", "c"])

    df = df.where(F.size("found") > 0).where(F.col("votes").isNotNull() if shared is None else F.col("votes").isNull())
    parts = df.select("found", "n", "votes").mapInArrow(run, schema)
    sums = parts.groupBy("f").agg(F.array(*[F.sum(F.col("c")[i]) for i in range(classes)]).alias("c"))
    table = np.zeros((BUCKETS, classes))
    found = sums.toArrow()  # at most BUCKETS rows
    if found.num_rows:
        table[found.column("f").to_numpy()] = np.array(found.column("c").combine_chunks().flatten()).reshape(-1, classes)
    return table


def _second(w: np.ndarray, sentences: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """For each document and subject (all classes but the last, `none`): the evidence of the second strongest
    sentence, and how many sentences are about it. A sentence's evidence for a subject is its lead over the best
    other class, so that a sentence counts for one subject only, and not for weak hints; -20 where there is none."""
    subjects = w.shape[1] - 1
    if isinstance(sentences, pa.ChunkedArray):
        sentences = sentences.combine_chunks()
    sizes = sentences.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    second, n = np.full((len(sizes), subjects), -20.0), np.zeros((len(sizes), subjects), np.int64)
    parts = sentences.flatten()
    if not len(parts):
        return second, n
    lengths = parts.value_lengths().to_numpy(zero_copy_only=False)  # no sentence is without features
    scores = np.add.reduceat(w[parts.flatten().to_numpy(zero_copy_only=False)], np.r_[0, np.cumsum(lengths)[:-1]], axis=0)
    two = np.partition(scores, -2, axis=1)[:, -2:]
    lead = scores - np.maximum(np.where(scores == two[:, 1:], two[:, :1], two[:, 1:]), 0.0)
    lead = np.minimum(lead, scores)[:, :subjects]
    some = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[some]
    best = np.maximum.reduceat(lead, starts, axis=0)
    ties = lead == np.repeat(best, sizes[some], axis=0)
    rest = np.maximum.reduceat(np.where(ties, -20.0, lead), starts, axis=0)
    second[some] = np.clip(np.where(np.add.reduceat(ties, starts, axis=0, dtype=np.int64) > 1, best, rest), -20, 20)
    n[some] = np.add.reduceat(lead > 0, starts, axis=0, dtype=np.int64)
    return second, n


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by penalised Newton steps, each halved until it does not make things worse;
    the penalty holds slope and offset near 1 and 0 where labels are few or leave nothing to tell."""

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float(np.logaddexp(0, z).sum() - (y * z).sum() + PRIOR * ((a - 1) ** 2 + b * b))

    a, b = 1.0, 0.0
    now = loss(a, b)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        v = p * (1 - p)
        g = np.array([((p - y) * x).sum() + 2 * PRIOR * (a - 1), (p - y).sum() + 2 * PRIOR * b])
        step = np.linalg.solve(np.array([[(v * x * x).sum() + 2 * PRIOR, (v * x).sum()], [(v * x).sum(), v.sum() + 2 * PRIOR]]), g)
        share = 1.0
        while share > 1e-4 and loss(a - share * step[0], b - share * step[1]) > now:
            share /= 2
        a, b = a - share * step[0], b - share * step[1]
        before, now = now, loss(a, b)
        if before - now < 1e-9:
            break
    return max(a, 0.05), b


def calibrated(x: np.ndarray, y: np.ndarray, wrong: float = WRONG) -> tuple[float, float]:
    """A logistic curve of evidence against labels of which a part is wrong: each round fits the curve to the chance that a
    document is about the subject, given its label and the last curve."""
    truth = np.where(y > 0, 1 - wrong, wrong)
    curve = (1.0, 0.0)
    for _ in range(12):
        curve = _logistic(x, truth)
        p = 1 / (1 + np.exp(-np.clip(curve[0] * x + curve[1], -30, 30)))
        yes, no = np.where(y > 0, 1 - wrong, wrong), np.where(y > 0, wrong, 1 - wrong)
        truth = p * yes / (p * yes + (1 - p) * no)
    return curve


class SubjectModel:
    """Feature weights, subject names and calibration curves."""

    def __init__(self, subjects: list[str], w: Weights, curves: list[tuple[float, float]]):
        self.subjects, self.w, self.curves = subjects, w, curves


def fit(sentences: DataFrame, labels: DataFrame, subjects: list[str], rounds: int = ROUNDS) -> tuple[SubjectModel, DataFrame]:
    """The model, and (key, sentences) as written to the shared folder.

    `sentences` comes from `featurise`; `labels` is (key, subject). Labels of unknown subjects count as
    `none`; repeated and contradicting labels count as votes; without any label nothing is found."""
    spark = sentences.sparkSession
    names = [*subjects, NONE]
    number = F.coalesce(*[F.when(F.col("subject") == s, F.lit(i)) for i, s in enumerate(subjects)], F.lit(len(subjects)))
    votes = labels.where(F.col("key").isNotNull() & F.col("subject").isNotNull()).groupBy("key").agg(
        F.array(*[F.sum((number == i).cast("double")) for i in range(len(names))]).alias("votes")
    )
    votes = cut(votes, "subject-votes")
    few = votes.count() <= BROADCAST_LABELS
    data = cut(sentences.join(F.broadcast(votes) if few else votes, "key", "left"), "subject-features")
    labelled = _count(data, len(names), None)
    w = weights(labelled)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Weights(w))
        w = weights(labelled + UNLABELLED * _count(data, len(names), shared))
        shared.destroy()
    w = Weights(w)
    sample = data.where(F.col("votes").isNotNull()).orderBy(F.xxhash64("key")).limit(MAX_LABELS).select("sentences", "votes").toArrow()
    x, _ = _second(w.whole, sample.column("sentences"))
    curves = [(1.0, 0.0)] * len(subjects)
    if len(x):
        y = np.array(sample.column("votes").to_pylist())[:, : len(subjects)] > 0
        curves = [calibrated(x[:, c], y[:, c].astype(float)) for c in range(len(subjects))]
    return SubjectModel(subjects, w, curves), data


def posteriors(data: DataFrame, model: SubjectModel) -> DataFrame:
    """(key, subject, n_sentences, evidence, posterior): for each document and every subject, how many of its sentences
    lead for it, the evidence of the second strongest and its calibrated posterior. A document without features has the posterior of no
    evidence; null and repeated keys pass through."""
    shared = data.sparkSession.sparkContext.broadcast(model)
    kind = data.schema["key"].dataType
    schema = T.StructType(
        [T.StructField("key", kind), T.StructField("subject", T.StringType()), T.StructField("n_sentences", T.LongType()), T.StructField("evidence", T.DoubleType()), T.StructField("posterior", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        subjects = len(m.subjects)
        slope, offset = np.array(m.curves).T if subjects else (np.zeros(0), np.zeros(0))
        for batch in batches:
            if not batch.num_rows or not subjects:
                continue
            evidence, n = _second(m.w.whole, batch.column(1))
            posterior = 1 / (1 + np.exp(-np.clip(slope * evidence + offset, -30, 30)))
            rows = np.repeat(np.arange(len(n)), subjects)
            names = pa.DictionaryArray.from_arrays(pa.array(np.tile(np.arange(subjects, dtype=np.int32), len(n))), pa.array(m.subjects, pa.string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), names, pa.array(n.ravel().astype(np.int64)), pa.array(evidence.ravel()), pa.array(posterior.ravel())], names=["key", "subject", "n_sentences", "evidence", "posterior"]
            )

    return data.select("key", "sentences").mapInArrow(run, schema)


def assign(data: DataFrame, model: SubjectModel, least: float = ASSIGNED) -> DataFrame:
    """The rows of `posteriors` above the given posterior: the subjects each document is about, none, one or several."""
    return posteriors(data, model).where(F.col("posterior") > least)
