"""Text that looks the same brought to the same characters, by DuckDB inside Arrow partitions.

One SQL expression per text: joiners that emoji and Devanagari need are set aside, other invisible
characters go, special spaces become spaces, full- and half-width letters, digits and kana and letters of
sign blocks are translated, `nfc_normalize` composes accents and syllables, and words that mix Latin with
Cyrillic, Greek or Armenian letters that only look Latin are put into one script. Nothing leaves its
partition; each Python worker keeps one DuckDB connection with one thread."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread

# Which letters look like which Latin letter.
CYRILLIC = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
            "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Һ": "H", "Ӏ": "I"}
GREEK = {"α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "υ": "u", "κ": "k", "χ": "x", "γ": "y", "ϲ": "c", "ϳ": "j",
         "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X"}
ARMENIAN = {"օ": "o", "ս": "u", "ո": "n", "հ": "h", "Օ": "O", "Տ": "S"}
#: Invisible: soft hyphen, grapheme joiner, Mongolian and Hangul fillers, zero widths, marks of direction, byte order mark.
INVISIBLE = r"[\x{AD}\x{34F}\x{61C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FEFF}\x{FFA0}]"
SPACES = r"[\x{A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}]"
_EMOJI = r"[\x{FE0F}\x{20E3}\x{2190}-\x{21FF}\x{2300}-\x{23FF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{1F000}-\x{1FAFF}]"
_WIDE = r"[\p{Han}\p{Hiragana}\p{Katakana}\x{3001}-\x{303F}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF1F}]"
#: A text of these characters alone is in its form already: Latin letters, Hangul syllables, kana, Han, common signs and punctuation, emoji.
ORDINARY = (
    r"[\t\n\r -~\x{A1}-\x{AC}\x{AE}-\x{17F}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20AC}\x{2190}-\x{22FF}\x{2460}-\x{24FF}\x{2500}-\x{2ABF}\x{2B00}-\x{2BFF}\x{3001}-\x{3029}"
    r"\x{3030}-\x{303F}\x{3041}-\x{3096}\x{309B}-\x{30FF}\x{3200}-\x{33FF}\x{3400}-\x{9FFF}\x{AC00}-\x{D7A3}\x{FE0F}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}\x{1F000}-\x{1FAFF}]*"
)
#: Noncharacters that stand in for what is set aside.
_ZWJ, _ZWNJ, _WIDE_SPACE = "\ufdd0", "\ufdd1", "\ufdd2"
#: Devanagari letters that composition leaves apart: both spellings are ordinary.
_APART = {chr(c): unicodedata.normalize("NFC", chr(c)) for c in range(0x958, 0x960)}


def _translation() -> tuple[str, str]:
    """Single letters, digits and kana of full- and half-width forms and sign blocks, and what they are."""
    ranges = [(0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A), (0xFF66, 0xFF9D), (0xFFA1, 0xFFDC), (0x2E80, 0x2FDF), (0x1D400, 0x1D7FF), (0x2100, 0x214F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)]
    pairs = {"ﾞ": "\u3099", "ﾟ": "\u309a"}
    for first, last in ranges:
        for c in map(chr, range(first, last + 1)):
            plain = unicodedata.normalize("NFKC", c)
            if plain != c and len(plain) == 1 and unicodedata.category(plain)[0] in "LN":
                pairs[c] = plain
    return "".join(pairs), "".join(pairs.values())


def _ligatures() -> dict[str, str]:
    """Letters written as one sign: ff, fi, fl, ... and the Arabic lam-alef forms."""
    return {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in [*range(0xFB00, 0xFB07), *range(0xFEF5, 0xFEFD)]}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replaced(expression: str, pairs: dict[str, str]) -> str:
    for old, new in pairs.items():
        expression = f"replace({expression}, {_quoted(old)}, {_quoted(new)})"
    return expression


def sql(source: str = "batch") -> str:
    """The query: key, text -> key, canonical, changed."""
    foreign = CYRILLIC | GREEK | ARMENIAN
    old, new = _translation()
    twins = "".join(foreign)
    to_cyrillic = {v: k for k, v in reversed(CYRILLIC.items())}
    script = r"\p{Cyrillic}\p{Greek}\p{Armenian}"
    to_latin = f"translate(w, {_quoted(twins)}, {_quoted(''.join(foreign.values()))})"
    back = f"translate(w, {_quoted(''.join(to_cyrillic))}, {_quoted(''.join(to_cyrillic.values()))})"
    return rf"""
with given as (
  select key, text, {_replaced("text", _APART)} as plain from {source} where not regexp_full_match(text, '{ORDINARY}')
), aside as (
  select *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(plain,
    '({_EMOJI})\x{{200D}}({_EMOJI})', '\1{_ZWJ}\2', 'g'), '({_EMOJI})\x{{200D}}({_EMOJI})', '\1{_ZWJ}\2', 'g'),
    '(\x{{94D}})\x{{200D}}(\p{{Devanagari}})', '\1{_ZWJ}\2', 'g'), '(\x{{94D}})\x{{200C}}(\p{{Devanagari}})', '\1{_ZWNJ}\2', 'g'),
    '({_WIDE})\x{{3000}}', '\1{_WIDE_SPACE}', 'g'), '\x{{3000}}({_WIDE})', '{_WIDE_SPACE}\1', 'g') as t from given
), clean as (
  select * replace (translate(regexp_replace(regexp_replace(t, '{INVISIBLE}', '', 'g'), '{SPACES}', ' ', 'g'), {_quoted(old)}, {_quoted(new)}) as t) from aside
), composed as (
  select * replace (nfc_normalize({_replaced("t", _ligatures())}) as t) from clean
), joined as (
  select * replace (replace(replace(replace(t, '{_ZWJ}', chr(8205)), '{_ZWNJ}', chr(8204)), '{_WIDE_SPACE}', chr(12288)) as t),
    regexp_matches(t, '[{script}]') as has_foreign,
    regexp_matches(t, '\p{{Latin}}') as has_latin,
    len(list_filter(regexp_extract_all(t, '[{script}]+'), lambda w: not regexp_matches(w, '^[{twins}]+$'))) > 0 as has_own_words
  from composed
), worded as (
  select *, case when not has_foreign or not (has_latin or not has_own_words) then t else
    array_to_string(list_transform(regexp_extract_all(t, '[\p{{Latin}}{script}\p{{M}}]+|[^\p{{Latin}}{script}\p{{M}}]+'), lambda w: case
      when not regexp_matches(w, '[{script}]') then w
      when regexp_matches(w, '\p{{Latin}}') and not regexp_matches(regexp_replace(w, '[{twins}]', '', 'g'), '[{script}]') then {to_latin}
      when regexp_matches(w, '\p{{Latin}}') and regexp_matches(w, '\p{{Cyrillic}}') and not regexp_matches(regexp_replace(w, '[{"".join(to_cyrillic)}]', '', 'g'), '\p{{Latin}}') then {back}
      when has_latin and not has_own_words then {to_latin}
      else w end), '') end as canonical
  from joined
)
select key, canonical, canonical <> plain as changed from worded
union all
select key, text, false from {source} where text is null or regexp_full_match(text, '{ORDINARY}')
"""


_CONNECTION = None


def _connection():
    global _CONNECTION
    if _CONNECTION is None:
        import duckdb

        _CONNECTION = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
    return _CONNECTION


def canonical_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, canonical, changed): the text of every row in its one form, and whether it was not in it.

    A null text stays null and counts as unchanged, an empty one stays empty. Keys are passed through, null
    or repeated ones too; other columns play no part. Case, punctuation and words are left as they are."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("canonical", T.StringType()), T.StructField("changed", T.BooleanType())])
    query = sql()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        connection = _connection()
        for record_batch in batches:
            connection.register("batch", pa.Table.from_batches([record_batch]))
            found = connection.sql(query).to_arrow_table()
            connection.unregister("batch")
            yield from found.cast(pa.schema([("key", record_batch.schema.field(0).type), ("canonical", pa.string()), ("changed", pa.bool_())])).to_batches()

    return spread(df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))).mapInArrow(run, schema)
