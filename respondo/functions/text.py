"""Text columns: stripping, null tokens, lenient JSON, templates, anchors and type cues."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import FILLERS, NULL_TOKENS, TYPE_ORDER

_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(c: Column) -> Column:
    """Outer white space removed, all of Unicode's."""
    return F.regexp_replace(c, _EDGES, "")


def null_tokens(c: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    """Null where the text is one of the tokens that mean no value."""
    return F.when(~c.isin(tokens), c)


def has_value(c: Column) -> Column:
    """Neither null nor blank nor a null token nor a filler."""
    bare = strip(c)
    return c.isNotNull() & ~bare.isin(sorted({*NULL_TOKENS, *FILLERS}))


def first_text(*columns: Column) -> Column:
    """The first non-null of several columns, stripped; null if that one is blank (later ones do not step in)."""
    return F.nullif(strip(F.coalesce(*columns)), F.lit(""))


def merged_text(*columns: Column) -> Column:
    """All columns joined by single spaces, nulls as empty slots."""
    return F.concat_ws(" ", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def number_text(c: Column) -> Column:
    """A numeric text as its whole number; other texts as they are."""
    return F.coalesce(c.try_cast("double").cast("bigint").cast("string"), c.cast("string"))


def cleaned_number(c: Column) -> Column:
    """The number in a text after commas, underscores, blanks, dashes and colons are deleted and outer
    parentheses are read as a minus; null where there is none."""
    bare = F.translate(strip(c.cast("string")), ",_ -:", "")
    signed = F.regexp_replace(bare, r"^\((.*)\)$", "-$1")
    return F.when(F.lower(bare).isin("nan", "inf", "infinity"), None).otherwise(signed.try_cast("double"))


def unfenced(c: Column) -> Column:
    """A JSON text without the code fence around it."""
    return F.regexp_replace(F.regexp_replace(strip(c), r"^```[A-Za-z]*\s*", ""), r"\s*```$", "")


def lenient_json(c: Column, schema: str, required: str) -> Column:
    """The parsed text, or its unfenced form if the text itself does not parse; null if neither has the
    required field."""
    first, second = F.from_json(c, schema), F.from_json(unfenced(c), schema)
    return F.when(first[required].isNotNull(), first).when(second[required].isNotNull(), second)


def template(pattern: str, /, **values: Column | str) -> Column:
    """A `{name}` template over columns; a name without a value is an error when the plan is built."""
    parts: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(pattern):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            value = values[name]
            parts.append(F.coalesce(value.cast("string"), F.lit("")) if isinstance(value, Column) else F.lit(str(value)))
    return F.concat(*parts) if parts else F.lit("")


def template_names(text: str) -> list[str]:
    """The distinct names a template needs, in order."""
    return list(dict.fromkeys(name for _, name, _, _ in string.Formatter().parse(text) if name is not None))


def anchor(c: Column) -> Column:
    """The number of a question in a label such as 문17-1, Q17_1 or B1701A: main and sub number joined by a
    dash, without leading zeros; null if there is none."""
    main = F.regexp_extract(c, r"(\d+)", 1)
    tail = F.regexp_extract(c, r"\d+\s*[-_.]\s*(\d+)", 1)
    four = F.regexp_extract(c, r"^[A-Za-z](\d{2})(\d{2})[A-Za-z]?$", 1)
    sub = F.regexp_extract(c, r"^[A-Za-z](\d{2})(\d{2})[A-Za-z]?$", 2)
    plain = lambda x: F.regexp_replace(x, r"^0+(?=\d)", "")
    return F.when(four != "", F.concat(plain(four), F.lit("-"), plain(sub))).when(
        (main != "") & (tail != ""), F.concat(plain(main), F.lit("-"), plain(tail))
    ).when(main != "", plain(main))


#: Words that tell a question's type.
CUES = {
    "etc": r"기타|[Oo]ther|その他|其他|etc\.",
    "depend": r"방금|고르신|답하신|선택하신|[Ww]hy did you|ticked|that answer|Antwort|esa respuesta|その理由|为什么选",
    "img": r"떠올릴|생각나는|이미지|comes to mind|zuerst ein|recuerda|思い浮かぶ|想到",
    "pos_neg": r"좋은 점|아쉬운 점|마음에 드|good and bad|Stärken und Schwächen|bueno y lo malo|良い点|优点",
    "concept": r"어떻게 느끼|광고|컨셉|concept|advert",
}


def question_type(c: Column) -> Column:
    """The type of a question text by its cues; where several apply, the earlier in the order of types wins.
    Compound types need both of their cues; an open question without any cue is about a concept."""
    has = {name: c.rlike(pattern) for name, pattern in CUES.items()}
    has["etc_pos_neg"] = has["etc"] & has["pos_neg"]
    has["depend_pos_neg"] = has["depend"] & has["pos_neg"]
    out = None
    for name in TYPE_ORDER:
        out = F.when(has[name], name) if out is None else out.when(has[name], name)
    return out.otherwise("concept")


def project_name(c: Column) -> Column:
    """A project's name from a file name: leading dates and dashes off, first run of letters, lower case."""
    rest = F.regexp_replace(c, r"(?U)^[-_\d년월일\s]+", "")
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(rest, r"[A-Za-z가-힣]+", 0)), F.lit("")), F.lit("default"))
