"""Sentence units of every document, in any script, by a hidden-event n-gram language model.

The model is a trigram model over words, marks and boundary tokens, estimated from answers whose
sentences are known (the analysed answers' lists of sentences), once as they are written and, for a part
of them, with their end marks taken away, so that it also knows how sentences join without marks. Between
any two words of a new text a boundary may or may not have happened; forward and backward sums over both
histories give each place its posterior, and places above one half end a sentence. Abbreviations,
decimals and quotations need no lists: they are contexts in which the boundary token was or was not seen.
Inside brackets and quotations no boundary is possible, nor at a place with neither a mark nor white space, unless it lies between two
signs of a script that writes on without spaces.

Words are units between spaces; Han and kana are taken sign by sign, Thai stretches by their first and
last signs, rare words by a class of their ending. The model is fitted on all analysed answers, which are read and cut into words once: the triples
of their words are counted where the answers are, the sums tell which words are rare, and with these put into their classes the sums come to the
driver and are broadcast. Their number grows with the vocabulary, not with the rows. Texts are then decoded partition by partition, whole, without a
shuffle."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, spread
from .personal import shadow

#: One in so many answers is also learned without end marks.
BARE_ONE_IN = 2
BOUNDARY = "</s>"
_DISCOUNT = 0.6
#: Different words or triples a task sums up before it hands them on.
_TOGETHER = 200_000
_END_FORMS = frozenset((".", "!", "?", "…", "~", "♪"))
_MARKS = ".!?…。！？।॥؟♪~～⋯‥"
_TOKEN = regex.compile(
    r"(?P<mail>[\w.+%-]+\s?(?:@|[(\[]at[)\]])\s?[\w-]+(?:(?:\.|[(\[]dot[)\]])[\w-]+)+)"
    r"|(?P<path>[A-Za-z]+(?:/\w+)+(?:\.[a-z]+)?)"
    r"|(?P<num>\p{N}+(?:[.,:/-]\p{N}+)*)"
    rf"|(?P<mark>(?:\s?\.\.\.)|[{regex.escape(_MARKS)}]+)"
    r"|(?P<thai>\p{Thai}+)"
    r"|(?P<sign>[\p{Han}\p{Hiragana}\p{Katakana}ー々])"
    r"|(?P<word>[\p{L}\p{M}]+(?:['’-][\p{L}\p{M}]+)*)"
    r"|(?P<other>\S)",
)
#: All of a line, piece by piece: a token, with the space after it where no token begins with that, or white space.
_PIECE = regex.compile(rf"(?:{regex.sub(r'\?P<[a-z]+>', '?:', _TOKEN.pattern)})(?: (?!\.\.\.))?|\s")
_PIECES = 100_000
_seen: dict[str, tuple[int, tuple[tuple[str, int, int], ...]]] = {}
_OPEN = {"(": ")", "（": "）", "[": "]", "「": "」", "『": "』", "“": "”", "„": "“", "«": "»", "《": "》", "【": "】", "‘": "’", "‹": "›"}
_CLOSERS = set(_OPEN.values())
_MARK_FORMS = _END_FORMS | _CLOSERS | {'"', "'"}
_ENCLOSING = regex.compile(r"""[(\[（「『“„«《【‘‹"'＂＇’]""")
#: The posterior above which a place without a mark ends a sentence: in a line that has marks; between two signs in such a line
#: and in one without marks.
BARE, BETWEEN_SIGNS, SIGNS_ALONE = 0.9, 0.995, 0.6
_SIGN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー々]")
_LABEL = regex.compile(r"[:：=＝]|\s[-–]\s")
_FIELDS = regex.compile(r"\s*[^:：=|;；/,，、.。!?！？]{1,40}(?:\s?[:：=＝]\s?|\s[-–]\s)[^:：=|;；/,，、.。!?！？]{1,60}(?:\s*[;；|｜/,，、]\s*[^:：=|;；/,，、.。!?！？]{1,40}(?:\s?[:：=＝]\s?|\s[-–]\s)[^:：=|;；/,，、.。!?！？]{1,60})+\s*[.。]?\s*")
_LINE = regex.compile(r"[^\n\r\x0b\x0c\x85\u2028\u2029]+")


def _mark(run: str) -> str:
    if len(run) == 1 and run in _END_FORMS:
        return run
    if any(c in run for c in "?？؟"):
        return "?"
    if any(c in run for c in "!！"):
        return "!"
    if "…" in run or "..." in run or "⋯" in run or "‥" in run:
        return "…"
    if any(c in run for c in ".。।॥"):
        return "."
    return run[0]


def _piece(piece: str) -> tuple[int, tuple[tuple[str, int, int], ...]]:
    """The length of a piece of a line, and (form, start, end) of what it holds; which kind of token it is shows in itself."""
    m = _TOKEN.match(piece)
    if m is None:
        found = ()
    else:
        kind, text = m.lastgroup, m.group()
        n = len(text)
        if kind == "word":
            found = ((text.casefold(), 0, n),)
        elif kind == "mark":
            found = ((_mark(text), 0, n),)
        elif kind == "num":
            found = (("<n>", 0, n),)
        elif kind == "thai":
            end = (text[-4:] + "$", n - min(4, n), n)
            found = (("^" + text[:3], 0, n - 4), end) if n > 6 else (end,)
        elif kind in ("mail", "path"):
            found = ((f"<{kind}>", 0, n),)
        else:
            found = ((text, 0, n),)
    if len(_seen) >= _PIECES:
        _seen.clear()
    known = _seen[piece] = (len(piece), found)
    return known


def _cut(line: str) -> list[tuple[str, int, int, bool]]:
    """The words, marks and signs of a line, as if each place were free."""
    found, at = [], 0
    for piece in _PIECE.findall(line):
        n, forms = _seen.get(piece) or _piece(piece)
        for form, a, b in forms:
            found.append((form, at + a, at + b, True))
        at += n
    return found


def tokens(line: str) -> list[tuple[str, int, int, bool]]:
    """(form, start, end, may end a sentence here) of each word, mark and sign of a line."""
    found = _cut(line)
    return _inside(line, found) if _ENCLOSING.search(line) else found


def _inside(line: str, found: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int, bool]]:
    """Mark the places within brackets and quotations that are closed again in the line."""
    shut = [False] * len(found)
    stack: list[tuple[str, int]] = []
    for i, (_, a, b, _) in enumerate(found):
        if b - a != 1:
            continue
        sign = line[a]
        if stack and sign == stack[-1][0]:
            _, since = stack.pop()
            for k in range(since, i):
                shut[k] = True
        elif sign in _OPEN:
            stack.append((_OPEN[sign], i))
        elif sign in "\"'＂＇’":
            if any(s == sign for s, _ in stack):
                while stack and stack[-1][0] != sign:
                    stack.pop()
                _, since = stack.pop()
                for k in range(since, i):
                    shut[k] = True
            elif sign != "’":
                stack.append((sign, i))
        elif sign in _CLOSERS and any(s == sign for s, _ in stack):
            while stack[-1][0] != sign:
                stack.pop()
            _, since = stack.pop()
            for k in range(since, i):
                shut[k] = True
    return [(form, a, b, not s) for (form, a, b, _), s in zip(found, shut)]


def _class(form: str) -> str:
    """The class of a rare word: its script and ending."""
    c = form[-1]
    if "가" <= c <= "힣":
        return "<ko>" + form[-2:]
    if form[0] == "^":
        return "<th^>"
    if c == "$":
        return "<th$>" + form[-3:-1]
    if len(form) == 1:
        return "<sign>" if ord(c) > 0x2E7F else "<mark>" if not c.isalpha() else "<letter>"
    return "<word>"


def _streams(sentences: list[str]) -> Iterator[list[list[str]]]:
    """The words of an answer's sentences as they are written and, of some answers, without end marks."""
    stream = [[form for piece in _PIECE.findall(" ".join(s.split())) for form, _, _ in (_seen.get(piece) or _piece(piece))[1]] for s in sentences if s and s.strip()]
    stream = [s for s in stream if s]
    if not stream:
        return
    yield stream
    if zlib.crc32("".join(sentences).encode()) % BARE_ONE_IN == 0:
        yield [s[:-1] if s[-1] in _END_FORMS and len(s) > 1 else s for s in stream]


def _triples(stream: list[list[str]], known: set[str] | None = None) -> Iterator[tuple[str, str, str]]:
    """The triples of a stream; with `known` words, others by their classes. Each word is the last of one triple."""
    flat = [BOUNDARY, BOUNDARY]
    for s in stream:
        flat += s if known is None else [f if f in known else _class(f) for f in s]
        flat.append(BOUNDARY)
    return zip(flat, flat[1:], flat[2:])


class BoundaryModel:
    """Trigram counts with interpolated absolute discounting over words and boundary tokens."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.one: list[float] = []
        self.two: dict[int, int] = {}
        self.three: dict[int, int] = {}
        self.context: list[tuple[int, int]] = []
        self.context2: dict[int, tuple[int, int]] = {}
        self.size = 0
        self.memory: dict[tuple, tuple] = {}
        self.numbers: dict[str, int] = {}
        self.ending: list[bool] = []
        self.starting: list[bool] = []

    # --- estimation

    @classmethod
    def fit(cls, answers: list[list[str]]) -> BoundaryModel:
        """From answers given as lists of sentences."""
        streams = [stream for sentences in answers for stream in _streams(sentences)]
        seen = Counter(form for stream in streams for s in stream for form in s)
        known = {form for form, n in seen.items() if n > 1}
        return cls.of_counts(Counter(t for stream in streams for t in _triples(stream, known)).items())

    @classmethod
    def of_counts(cls, counts: Iterable[tuple[tuple[str, str, str], int]]) -> BoundaryModel:
        """From the triples of all answers with their numbers, each triple once."""
        model = cls()
        index = model.ids
        index[BOUNDARY] = 0
        triples: dict[tuple[int, int, int], int] = {}
        lonely: Counter = Counter()
        for forms, count in counts:
            u, v, w = (index.setdefault(f, len(index)) for f in forms)
            triples[u, v, w] = count
            lonely[w] += count
            if u == v == 0:  # an answer begins with two boundaries, the second of which counts
                lonely[0] += count
        for rest in ("<word>", "<sign>", "<mark>", "<letter>", "<th^>", "<n>", "<mail>", "<path>"):
            index.setdefault(rest, len(index))
        n = model.size = len(index)
        total = sum(lonely.values())
        model.one = [(lonely.get(i, 0) + 0.1) / (total + 0.1 * n) for i in range(n)]
        pairs: Counter = Counter()
        after2: dict[int, list[int]] = {}
        for (u, v, w), count in triples.items():
            pairs[v * n + w] += count
            slot = after2.setdefault(u * n + v, [0, 0])
            slot[0] += count
            slot[1] += 1
            if count > 1:
                model.three[(u * n + v) * n + w] = count
        after = [[0, 0] for _ in range(n)]
        for pair, count in pairs.items():
            slot = after[pair // n]
            slot[0] += count
            slot[1] += 1
        model.two = dict(pairs)
        model.context = [tuple(x) for x in after]
        model.context2 = {k: tuple(x) for k, x in after2.items()}
        return model

    # --- probabilities

    def number(self, form: str) -> int:
        found = self.ids.get(form)
        if found is None:
            found = self.numbers.get(form)
        if found is None:
            found = self.ids.get(_class(form), self.ids["<word>"])
            if len(self.numbers) > 400_000:
                self.numbers.clear()
            self.numbers[form] = found
        return found

    def p(self, u: int, v: int, w: int) -> float:
        n = self.size
        q = self.one[w]
        total, kinds = self.context[v]
        if total:
            q = (max(self.two.get(v * n + w, 0) - _DISCOUNT, 0.0) + _DISCOUNT * kinds * q) / total
        pair = u * n + v
        found = self.context2.get(pair)
        if found:
            total, kinds = found
            q = (max(self.three.get(pair * n + w, 0) - _DISCOUNT, 0.0) + _DISCOUNT * kinds * q) / total
        return q

    def _steps(self, u: int, v: int, w: int) -> tuple[float, float, float, float]:
        """Weights of the step from word v to word w: (no boundary before v, none after; none before, one
        after; one before, none after; one before, one after). u is the word before v."""
        key = (u, v, w)
        found = self.memory.get(key)
        if found is None:
            start = self.p(v, 0, w)
            found = (self.p(u, v, w), self.p(u, v, 0) * start, self.p(0, v, w), self.p(0, v, 0) * start)
            if len(self.memory) > 400_000:
                self.memory.clear()
            self.memory[key] = found
        return found

    def enders(self) -> list[bool]:
        """For each word, whether it was seen before a boundary."""
        if not self.ending:
            self.ending = [v * self.size in self.two for v in range(self.size)]
        return self.ending

    def starters(self) -> list[bool]:
        """For each word, whether it was seen after a boundary."""
        if not self.starting:
            self.starting = [v in self.two for v in range(self.size)]
        return self.starting

    def posteriors(self, words: list[int], allowed: list[bool]) -> dict[int, float]:
        """The probability of a boundary after each allowed word but the last, by forward and backward
        sums over runs of allowed places; places not allowed have none, which cuts the chain."""
        out: dict[int, float] = {}
        n = len(words)
        i = 0
        while i < n - 1:
            if not allowed[i]:
                i += 1
                continue
            first = i
            while i < n - 1 and allowed[i]:
                i += 1
            last = i - 1  # places first..last may hold boundaries
            steps = []
            for k in range(first, last + 2):
                u = words[k - 1] if k > 0 else 0
                w = words[k + 1] if k + 1 < n else 0
                steps.append(self._steps(u, words[k], w) if k + 1 < n else (self.p(u, words[k], 0), 0.0, self.p(0, words[k], 0), 0.0))
            begins = first == 0
            a0, a1 = (steps[0][2], steps[0][3]) if begins else (steps[0][0], steps[0][1])
            forward = [(a0, a1)]
            for s in steps[1:-1]:
                a0, a1 = a0 * s[0] + a1 * s[2], a0 * s[1] + a1 * s[3]
                scale = a0 + a1 or 1.0
                a0, a1 = a0 / scale, a1 / scale
                forward.append((a0, a1))
            b0, b1 = steps[-1][0], steps[-1][2]
            for k in range(len(forward) - 1, -1, -1):
                f0, f1 = forward[k]
                yes, no = f1 * b1, f0 * b0
                out[first + k] = yes / (yes + no) if yes + no > 0 else 0.0
                if k:
                    s = steps[k]
                    b0, b1 = s[0] * b0 + s[1] * b1, s[2] * b0 + s[3] * b1
                    scale = b0 + b1 or 1.0
                    b0, b1 = b0 / scale, b1 / scale
        return out


def sentence_ends(model: BoundaryModel, text: str | None, threshold: float = 0.5) -> list[int]:
    """The place just after each sentence's last character. A blank or null text has no sentences; a line
    break always ends one; a line of labelled fields is one. In a line that has end marks, a place without
    one needs a posterior of at least `BARE`, a place between two signs `BETWEEN_SIGNS`, or `SIGNS_ALONE` in a line without any."""
    if not text:
        return []
    plain, at = shadow(text)
    ends: list[int] = []
    for m in _LINE.finditer(plain):
        line, base = m.group(), m.start()
        if line.isspace():
            continue
        found = tokens(line)
        if not found:
            continue
        last = len(found) - 1
        if last > 0 and not (_LABEL.search(line) and _FIELDS.fullmatch(line)):
            words = [model.number(form) for form, *_ in found]
            allowed = []
            may_end, may_start, marked = model.enders(), model.starters(), False
            for i, (form, _, b, free) in enumerate(found):
                mark = form in _MARK_FORMS
                if i == last or not free or not (mark or may_end[words[i]]):
                    allowed.append(False)
                    continue
                following = found[i + 1]
                glued = following[1] == b
                if following[0] in _END_FORMS:
                    allowed.append(False)
                elif not glued:
                    allowed.append(may_end[words[i]])
                    marked |= mark
                elif (nxt := line[b]) in ",、，;:；：" or nxt in _CLOSERS:
                    allowed.append(False)
                elif line[b - 1] == "." and not (following[2] - following[1] > 1 and i and found[i - 1][2] - found[i - 1][1] > 1 and found[i - 1][0] != "<n>"):
                    allowed.append(False)  # 2.º, U.S.
                else:
                    allowed.append(may_end[words[i]] and (mark or (may_start[words[i + 1]] and _SIGN.match(line, b - 1) is not None and _SIGN.match(nxt) is not None)))
                    marked |= mark
            marked |= found[last][0] in _END_FORMS
            for i, probability in model.posteriors(words, allowed).items():
                form, _, b, _ = found[i]
                bare = form not in _MARK_FORMS
                if bare and found[i + 1][1] == b:
                    least = max(threshold, BETWEEN_SIGNS if marked else SIGNS_ALONE)
                else:
                    least = max(threshold, BARE) if bare and marked else threshold
                if probability > least:
                    ends.append(base + b)
        ends.append(base + found[last][2])
    ends.sort()
    if at is None:
        return ends
    return [_original_end(text, at, e) for e in ends]


def _original_end(text: str, at: list[int], end: int) -> int:
    """The place in the stored text after the character that the plain character before `end` stands for."""
    start = at[end - 1]
    following = next((x for x in at[end:] if x > start), len(text))
    stop = following
    piece = text[start:stop]
    return start + len(piece.rstrip().rstrip("\u200b\u200c\u2060\ufeff\u00ad").rstrip()) if piece.strip() else stop


def _sums(answers: DataFrame) -> DataFrame:
    """(u, v, w, n): how often each triple of words occurs in the answers' streams; tasks add up before they hand on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def taken() -> pa.RecordBatch:
            columns = [pa.array(c, pa.string()) for c in zip(*held)] or [pa.array([], pa.string())] * 3
            return pa.RecordBatch.from_arrays([*columns, pa.array(list(held.values()), pa.int64())], names=["u", "v", "w", "n"])

        for batch in batches:
            for sentences in batch.column(0).to_pylist():
                for stream in _streams([s for s in sentences if s]):
                    held.update(_triples(stream))
                if len(held) >= _TOGETHER:
                    yield taken()
                    held.clear()
        yield taken()

    counted = spread(answers).mapInArrow(run, "u string, v string, w string, n bigint")
    return counted.groupBy("u", "v", "w").agg(F.sum("n").alias("n"))


def _classed(triples: DataFrame, known: set[str]) -> DataFrame:
    """`triples` (u, v, w, n) with words that are not `known` put into their classes, each triple once."""
    shared = triples.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in batches:
            columns = []
            for column in batch.columns[:3]:
                coded = column.dictionary_encode()
                forms = [f if f in common or f == BOUNDARY else _class(f) for f in coded.dictionary.to_pylist()]
                columns.append(pa.array(forms, pa.string()).take(coded.indices))
            yield pa.RecordBatch.from_arrays([*columns, batch.column(3)], names=["u", "v", "w", "n"])

    return triples.mapInArrow(run, triples.schema).groupBy("u", "v", "w").agg(F.sum("n").alias("n"))


def fit_model(analysed: DataFrame, key: str, sentences: str) -> BoundaryModel:
    """The model of a table of answers with known sentences (an array column), from all its rows; the key plays no part."""
    answers = analysed.where(F.size(sentences) > 0).select(F.col(sentences).cast("array<string>").alias("s"))
    triples = cut(_sums(answers), "sentence-triples")
    words = triples.where(F.col("w") != BOUNDARY).groupBy("w").agg(F.sum("n").alias("n"))
    known = set(words.where("n > 1").select("w").toArrow().column(0).to_pylist())
    found = _classed(triples, known).orderBy("u", "v", "w").toArrow()
    return BoundaryModel.of_counts(((u, v, w), n) for b in found.to_batches() for u, v, w, n in zip(*(c.to_pylist() for c in b.columns)))


def split_documents(df: DataFrame, key: str, text: str, model: BoundaryModel) -> DataFrame:
    """(key, ordinal, start_pos, end_pos): one row per sentence, ordinal from 0, positions in code points.

    Null, empty and blank texts give no rows; null and repeated keys pass through; other columns play no part."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *[T.StructField(c, T.LongType()) for c in ("ordinal", "start_pos", "end_pos")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = shared.value
        for batch in batches:
            rows, ordinals, starts, stops = [], [], [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                begin = 0
                for k, end in enumerate(sentence_ends(decode, value)):
                    part = value[begin:end]
                    rows.append(i)
                    ordinals.append(k)
                    starts.append(begin + len(part) - len(part.lstrip()))
                    stops.append(end)
                    begin = end
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(x, pa.int64()) for x in (ordinals, starts, stops)]], names=[key, "ordinal", "start_pos", "end_pos"])

    return spread(df.select(F.col(key), F.col(text).cast("string"))).mapInArrow(run, schema)
