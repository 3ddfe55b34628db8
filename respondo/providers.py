"""Text completion and embedding behind one interface, deterministic by default.

A completion provider turns prompts into structured answers and usage; the engine calls it once per
distinct prompt inside Arrow batches. `RuleProvider` follows written rules and needs no service;
`ReplayProvider` answers from recorded responses joined on the prompt's digest; `HttpProvider` is a hook
for a service and is never used in tests. Token counts of the rules are a quarter of the characters."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constants import FILLERS, MAX_ATOMIC, VECTOR_SIZE

COMPLETION = "content string, model string, prompt_tokens int, completion_tokens int, latency_ms int, error string"


class LLMError(Exception):
    kind = "llm_error"


class CreditError(LLMError):
    kind = "credit"


class ServiceError(LLMError):
    kind = "openai_error"


class UnsupportedFileError(Exception):
    kind = "unsupported_file"


class CompletionProvider(Protocol):
    model: str

    def complete(self, system: str, user: str) -> str: ...


def tokens_of(text: str) -> int:
    return -(-len(text) // 4)


@dataclass
class RuleProvider:
    """Answers by task rules: `grammar`, `analysis`, `choices`, `summary`."""

    task: str
    model: str = "rules"

    def complete(self, system: str, user: str) -> str:
        return json.dumps(RULES[self.task](user), ensure_ascii=False)


@dataclass
class HttpProvider:
    """A service reached through a function of (model, system, user); errors are typed by it."""

    model: str
    call: Callable[[str, str, str], str] = field(repr=False)

    def complete(self, system: str, user: str) -> str:
        return self.call(self.model, system, user)


def corrected(text: str) -> str:
    """Fillers, runs of white space and repeated end marks out; a space after a mark that has none."""
    for filler in FILLERS:
        text = re.sub(rf"(?<!\w){re.escape(filler)}(?!\w)", "", text)
    text = re.sub(r"[^\S\n]+", " ", text).strip()
    text = re.sub(r"([!?])\1+", r"\1", text)
    return re.sub(r"([a-z가-힣][.!?])(?=[A-Z가-힣])", r"\1 ", text)


def atomic(text: str) -> list[str]:
    """At most three sentences, by end marks and line ends."""
    parts = re.split(r"(?<=[.!?。！？])\s+|(?<=[。！？])|\n+", text)
    return [p.strip() for p in parts if p and p.strip()][:MAX_ATOMIC]


POSITIVE = ("좋", "만족", "편하", "친절", "감사", "good", "great", "better", "love", "gut", "bueno", "mejor", "良い", "好", "满意")
NEGATIVE = ("나쁘", "불만", "아쉬", "못 미", "비싸", "느리", "걱정", "bad", "worse", "letdown", "slow", "schlecht", "peor", "decepción", "悪い", "残念", "失望", "贵")


def sentiment(text: str) -> str:
    low = text.lower()
    score = sum(w in low for w in POSITIVE) - sum(w in low for w in NEGATIVE)
    return "POSITIVE" if score > 0 else "NEGATIVE" if score < 0 else "NEUTRAL"


def keywords(sentence: str) -> dict[str, list[str]]:
    """Subject, verb and complement by position: words with subject particles, the last word, the rest."""
    words = [w.strip(".,!?~…\"'“”()") for w in sentence.split()]
    words = [w for w in words if w]
    if not words:
        return {"S": [], "V": [], "C": []}
    subjects = [w[:-1] for w in words[:-1] if len(w) > 1 and w[-1] in "은는이가"] or words[:1]
    rest = [w for w in words[1:-1] if w[:-1] not in subjects]
    return {"S": subjects, "V": words[-1:] if len(words) > 1 else [], "C": rest}


#: Answers that say that there is none.
NO_ANSWER = frozenset("없음 없다 없어요 없습니다 모름 모르겠다 모르겠어요 none nothing no idea don't know n/a keine nichts nada ninguno 特になし なし わからない 没有 不知道 нет".split()) | {"no idea", "don't know", "weiß nicht", "no sé"}


def analysis(prompt: str) -> dict:
    """An answer's analysis. A prompt of several lines ends with `Answer: ...`; what stands before it, question and
    explanation of the choice, decides what the answer says where it says nothing of its own."""
    _, marker, answer = prompt.rpartition("\nAnswer: ")
    text = answer if marker else prompt
    sentences = atomic(text)
    bare = text.strip(" .!?~…。！？").casefold()
    polarity = sentiment(text)
    if polarity == "NEUTRAL" and marker and "explains a choice: " in prompt:
        polarity = sentiment(prompt.split("explains a choice: ", 1)[1].split("\n", 1)[0])
    return {
        "matching_question": bool(bare) and bare not in NO_ANSWER, "pos_neg": polarity, "automic_sentence": sentences,
        "SVC_keywords": {f"sentence{i + 1}": keywords(s) for i, s in enumerate(sentences)},
    }


CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"


def choices(question: str) -> dict:
    """The numbered choices of a question: circled digits or n. / n), with ranges such as ①~③ spread out."""
    plain = re.sub(r"[①-⑳]", lambda m: f"\n{CIRCLED.index(m.group()) + 1}. ", question)
    answers: dict[str, str] = {}
    for first, last, text in re.findall(r"(?:^|\s)(\d{1,2})\s*(?:[.)]\s*)?(?:~\s*(\d{1,2})\s*)?[.)]\s*([^\n]*?)(?=\s+\d{1,2}\s*[.)~]|\n|$)", plain):
        for n in range(int(first), int(last or first) + 1):
            answers[str(n)] = text.strip()
    return {"question": re.split(r"[①-⑳]|\s\d{1,2}[.)]", question)[0].strip(), "answers": answers}


RULES: dict[str, Callable[[str], dict]] = {"grammar": lambda t: {"corrected": corrected(t)}, "analysis": analysis, "choices": choices, "summary": lambda t: {"summary": " ".join(atomic(t))}}


def complete(df: DataFrame, prompt: str, provider: CompletionProvider, system: str = "") -> DataFrame:
    """The rows with a struct `completion`. Each distinct prompt is sent once, in Arrow batches; a failed call
    is a row with its error type and no content, never a lost row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text in pdf["_prompt"]:
                try:
                    content, error = provider.complete(system, text), None
                except LLMError as failure:
                    content, error = None, failure.kind
                except Exception:  # noqa: BLE001 - whatever a provider raises becomes a row
                    content, error = None, "unknown"
                out.append((text, content, provider.model, tokens_of(system + text), tokens_of(content or ""), 0, error))
            yield pd.DataFrame(out, columns=["_prompt", "content", "model", "prompt_tokens", "completion_tokens", "latency_ms", "error"])

    asked = df.where(F.col(prompt).isNotNull()).select(F.col(prompt).alias("_prompt")).distinct().mapInPandas(run, f"_prompt string, {COMPLETION}")
    answers = asked.select("_prompt", F.struct("content", "model", "prompt_tokens", "completion_tokens", "latency_ms", "error").alias("completion"))
    return df.join(answers, df[prompt] == answers["_prompt"], "left").drop("_prompt")


def replay(df: DataFrame, prompt: str, recorded: DataFrame) -> DataFrame:
    """The rows with `content` from recorded (digest, content), joined on the prompt's SHA-256."""
    return df.withColumn("_digest", F.sha2(F.col(prompt), 256)).join(recorded.withColumnRenamed("digest", "_digest"), "_digest", "left").drop("_digest")


ANALYSIS = "matching_question boolean, pos_neg string, `pos.neg` string, automic_sentence array<string>, SVC_keywords map<string,struct<S:array<string>,V:array<string>,C:array<string>>>"


def analysis_record(parsed: Column) -> Column:
    """A parsed analysis with its defaults: no match, NEUTRAL (also under the key pos.neg), empty lists."""
    return F.struct(
        F.coalesce(parsed["matching_question"], F.lit(False)).alias("matching_question"),
        F.upper(F.coalesce(parsed["pos_neg"], parsed["pos.neg"], F.lit("NEUTRAL"))).alias("pos_neg"),
        F.slice(F.coalesce(parsed["automic_sentence"], F.array().cast("array<string>")), 1, MAX_ATOMIC).alias("automic_sentence"),
        F.coalesce(parsed["SVC_keywords"], F.create_map().cast("map<string,struct<S:array<string>,V:array<string>,C:array<string>>>")).alias("svc_keywords"),
    )


def hash_vector(text: str, size: int = VECTOR_SIZE) -> np.ndarray:
    """A unit vector of hashed character sequences of one to three signs; of a blank text, zeros."""
    out = np.zeros(size, np.float32)
    bare = re.sub(r"\s+", " ", text.strip().lower())
    for n in (1, 2, 3):
        for i in range(len(bare) - n + 1):
            code = zlib.crc32(bare[i : i + n].encode())
            out[code % size] += 1.0 if code & 0x80000000 else -1.0
    length = float(np.linalg.norm(out))
    return out / length if length else out


def encode(df: DataFrame, text: str, size: int = VECTOR_SIZE) -> DataFrame:
    """The rows with `emb`. Distinct texts are encoded once; null and blank texts give an empty vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"_text": pdf["_text"], "emb": [hash_vector(t, size).tolist() if t.strip() else [] for t in pdf["_text"]]})

    vectors = df.where(F.col(text).isNotNull()).select(F.col(text).alias("_text")).distinct().mapInPandas(run, "_text string, emb array<float>")
    return df.join(vectors, df[text] == vectors["_text"], "left").drop("_text").withColumn("emb", F.coalesce("emb", F.array().cast("array<float>")))
