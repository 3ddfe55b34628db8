"""Personal data in free text: found, typed, and replaced by placeholders that keep equal values linked.

Mentions are found in a normalised shadow of the text - invisible characters dropped, full-width forms,
split syllables and look-alike letters brought to their plain form - whose every character knows its place
in the original, so positions and replacements refer to the text as stored. Numbers are checked before
they count: length, grouping and lead digits by country, dates inside identity numbers, and the word before, as numbers of orders and
bookings are none. Each value is replaced by a typed placeholder with a pseudonym. Numbers are permuted by a keyed Feistel network
within their format: separators, grouping, letters, masks and a phone's lead digits stay, dates inside identity numbers are
permuted among valid dates, the same number has the same digits in every document whatever its notation, and no two numbers of a
format share them. Names, addresses and e-mail addresses have no format to keep; they get a code of 60 bits from a keyed digest, so two of them
share one by chance only. Nothing is looked up or shuffled."""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread
from .lookalikes import CYRILLIC, GREEK

KINDS = ("email", "phone", "id_number", "address", "person")

# --- the shadow text ---------------------------------------------------------------------------------

_PLAIN = re.compile(r"[\t\n -~¡-¬®-ž‐-‧‰-⁞€←-⋿①-⓿─-⯿、-〩〰-〿ぁ-ゖ゛-ヿ㈀-㏿㐀-鿿가-힣！-／：-～\U0001F000-\U0001FAFF]*")
_UNIT = re.compile(r"(?s).[\u0300-\u036f\u3099\u309aﾞﾟ\u1161-\u11ff]*")
_GONE = re.compile(r"[\u00ad\u034f\u061c\u115f\u1160᠋-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufeff]")
_SPACE = re.compile(r"[\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000]")
_TO_LATIN = str.maketrans(CYRILLIC | GREEK)
_OWN_WORD = re.compile(f"[Ѐ-ӿͰ-Ͽ](?<![{''.join(CYRILLIC | GREEK)}])")


def shadow(text: str) -> tuple[str, list[int] | None]:
    """The plain form and, for each of its characters and its end, the place in `text` (None: the same)."""
    if _PLAIN.fullmatch(text):
        return text, None
    latin = not _OWN_WORD.search(text)
    out, at = [], []
    units = _UNIT.finditer(text)
    for unit in units:
        piece = _GONE.sub("", unit.group())
        if not piece:
            continue
        piece = _SPACE.sub(" ", piece)
        if len(piece) > 1 or "⺀" <= piece <= "\u2fdf" or "\uff00" <= piece <= "\uffef" or "\U0001d400" <= piece <= "\U0001d7ff":
            piece = unicodedata.normalize("NFKC", piece)
        if latin:
            piece = piece.translate(_TO_LATIN)
        out.append(piece)
        at += [unit.start()] * len(piece)
    plain = "".join(out)
    composed = unicodedata.normalize("NFC", plain)
    if composed != plain and len(composed) != len(plain):  # syllables split by something invisible
        plain, at = _compose(plain, at)
    at.append(len(text))
    return plain, at


def _compose(plain: str, at: list[int]) -> tuple[str, list[int]]:
    out, where = [], []
    for unit in _UNIT.finditer(plain):
        piece = unicodedata.normalize("NFC", unit.group())
        out.append(piece)
        where += [at[unit.start()]] * len(piece)
    return "".join(out), where


# --- patterns ----------------------------------------------------------------------------------------

_I = re.IGNORECASE
_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*\s{0,2}(?:@|[(\[{]\s?(?:at|골뱅이)\s?[)\]}])\s{0,2}[A-Za-z0-9-]+"
    r"(?:(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)[A-Za-z0-9-]+)*(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)[A-Za-z]{2,}(?![A-Za-z0-9])",
    _I,
)
_D = "공영일이삼사오육칠팔구"
_BEFORE, _AFTER = r"(?<![\d.,/-])(?<![A-Za-z])", r"(?![\d-]|[.,/]\d)"
_PHONE = re.compile(
    "|".join(
        [
            rf"{_BEFORE}\+\d{{1,3}}[ .-]?\(?\d{{1,4}}\)?(?:[ .-]?\d{{2,8}}){{1,4}}{_AFTER}",
            rf"{_BEFORE}00(?:[1-9]\d{{0,2}}) ?\(?\d{{1,4}}\)?(?: \d{{2,8}}){{1,4}}{_AFTER}",
            rf"(?<!\d)\(0\d{{1,4}}\) ?\d{{3,8}}(?:[ -]\d{{3,4}})?{_AFTER}",
            rf"(?<!\d)\([2-9]\d\d\) ?\d{{3}}[ .-]\d{{4}}{_AFTER}",
            rf"{_BEFORE}(?:1[ .-])?[2-9]\d\d([.-])\d{{3}}\1\d{{4}}(?: ?(?:ext\.?|x) ?\d{{1,5}})?{_AFTER}",
            rf"{_BEFORE}[2-9]\d\d-\d{{4}}{_AFTER}",
            rf"{_BEFORE}01[016789][ .-]?\d{{3,4}}[ .-]?\d{{4}}{_AFTER}",
            rf"{_BEFORE}0(?:2|[3-6]\d|70|80|90|50\d)[ .-]?\d{{3,4}}[ .-]?\d{{4}}{_AFTER}",
            rf"{_BEFORE}0[1-9]\d{{1,3}}[ /-]\d{{3,8}}(?:[ -]\d{{2,5}})?{_AFTER}",
            rf"{_BEFORE}[67]\d\d(?:([ .-])\d{{3}}\2\d{{3}}|([ .-])\d\d\3\d\d\3\d\d|\d{{6}}){_AFTER}",
            rf"{_BEFORE}1\d\d([ -]?)\d{{4}}\4\d{{4}}{_AFTER}",
            rf"(?<![{_D}])공일[공일육칠팔구][ -]?[{_D}]{{3,4}}[ -]?[{_D}]{{4}}(?![{_D}])",
        ]
    ),
    _I,
)
_ID = re.compile(
    "|".join(
        [
            r"(?<![\d*-])(?P<rrn>\d{6}) ?[-–] ?[1-8*][\d*●]{6}(?![\d*])",
            r"(?<![\d*-])(?P<rrn2>\d{6})[1-8]\d{6}(?![\d*])",
            r"(?<![\w-])(?:\d{3}|[x*]{3})([- ])(?:\d\d|[x*]{2})\3\d{4}(?![\w-])",
            r"(?<![\w.+-])9\d{8}(?![\w-])",
            r"(?:(?<=number )|(?<=with )|(?<=ssn )|(?<=ssn: )|(?<=itin ))\d{9}(?![\w-])",
            r"(?<![\w.+-])\d\d([ /])\d{3}\4\d{3}\4\d{3}(?![\w/-])",
            r"(?<![\w.+-])00\d{9}(?![\w-])",
            r"(?:(?<=steuernummer )|(?<=steuer-id )|(?<=idnr\. ))\d{11}(?![\w-])",
            r"(?<![\w.-])[xyz]-?\d{7}-?[a-z](?![\w-])",
            r"(?<![\w.-])\d\d(\.?)\d{3}\5\d{3}-?[a-z](?![\w-])",
            r"(?<![\w-])\d{6}(?:19|20|\*\*)[\d*]{9}[\dx*](?![\w-])",
            r"(?<![\w-])[a-z]{2} ?\d\d ?\d\d ?\d\d ?[a-d](?![\w-])",
        ]
    ),
    _I,
)
_KO_UNIT = r"[가-힣]{1,8}"
_JA, _HAN = "一-鿿々ぁ-んァ-ヶー", "一-鿿"
_TOWN = r"(?!(?:and|please|has|is|the|was)\b)[^\W\d_]+(?!\w)(?:\s+(?!(?:and|please|has|is|the|was)\b)[^\W\d_]+(?!\w))?"
_ADDRESS = re.compile(
    "|".join(
        [
            # province or city, district, then a road with numbers or a lot number
            rf"(?<![가-힣])(?:{_KO_UNIT}(?:특별자치시|특별시|광역시|특별자치도|시|도)\s+)?(?:{_KO_UNIT}[구군]\s+)?(?:{_KO_UNIT}[읍면동]\s+)?(?:{_KO_UNIT}리\s+)?"
            rf"(?:(?<=[시구군읍면동리도]\s)|(?<=\s\s)){_KO_UNIT}(?:대로|로|길)\s*\d+(?:\s*번?길)?(?:\s*\d+(?:-\d+)?)?(?:,\s*(?:지하\s*)?\d+층)?",
            rf"(?<![가-힣])(?:{_KO_UNIT}(?:특별자치시|특별시|광역시|특별자치도|시|도)\s+)?(?:{_KO_UNIT}[구군]\s+)?(?:{_KO_UNIT}[읍면]\s+)?{_KO_UNIT}[동리]\s+\d+(?:-\d+)?(?:번지)?(?![\d가-힣명])(?:\s+{_KO_UNIT}(?:아파트|빌라|맨션|타운)\s*(?:\d+동\s*)?(?:\d+호)?)?",
            rf"(?:(?<=住所は)|(?<=住所：)|(?<=届け先は)|(?<![{_JA}]))(?!住所|届け先)(?:〒\s?\d{{3}}-?\d{{4}}\s*(?:[{_JA}]{{1,6}}?[都道府県])?[{_JA}]{{1,8}}?[市区町村郡][{_JA}]{{0,8}}?|(?:[{_JA}]{{1,6}}?[都道府県])?[{_JA}]{{1,6}}?[市区町村郡][{_JA}]{{1,10}}?)\d+(?:丁目\s*\d+(?:番地?)?(?:\d+号)?|(?:-\d+)+|番地?(?:\d+号)?)",
            rf"(?:(?<=址是)|(?<=址：)|(?<=址:)|(?<=址为)|(?<=住在)|(?<=寄到)|(?<=送到)|(?<![{_HAN}]))(?:[{_HAN}]{{2,4}}省)?(?:[{_HAN}]{{2,4}}[市县镇州])?(?:[{_HAN}]{{2,4}}[区县镇乡])?[{_HAN}]{{1,6}}(?:路|街|大道|巷|道)\s*\d+(?:弄\s*\d+)?号(?:\s*\d+[栋幢座])?(?:\s*\d+单元)?(?:\s*\d+[室号])?",
            rf"(?<![\w.])\d{{1,5}}[a-z]?\s+(?:[nsew]\.\s+)?(?:(?!(?:the|about|for|times|out|of|a|an|in|at)\b)[^\W\d_][\w'’-]*\s+){{1,3}}?(?:road|rd\.|street|st\.|lane|ln\.|court|ct\.|avenue|ave\.|drive|dr\.|boulevard|blvd\.|square|terrace|close|crescent|way)(?!\w)(?:,?\s+(?:flat|apt\.?|unit|suite|apartment)\s+\w+)?(?:,?\s+{_TOWN})?(?:,?\s+(?:\d{{5}}(?:-\d{{4}})?|[a-z]{{1,2}}\d{{1,2}}[a-z]?\s+\d[a-z]{{2}})\b)?",
            rf"(?<!\w)p\.?\s?o\.?\s+box\s+\d+(?:,\s+{_TOWN})?(?:,?\s+\d{{5}})?",
            rf"(?<!\w)(?:am|im|an\s+der|an\s+den|zum|zur|auf\s+der|auf\s+dem|in\s+der|hinter\s+der|unter\s+den)\s+(?:[^\W\d_][\w-]*\s+){{1,3}}?\d{{1,4}}\s?[a-z]?,\s+\d{{5}}\s+[^\W\d_][\w-]*",
            rf"(?<!\w)[^\W\d_][\w-]*(?:str\.|straße|strasse|weg|platz|allee|gasse|ring|ufer|damm|steig|pfad)\s+\d{{1,4}}\s?[a-z]?,\s+(?:\d{{5}}\s+)?[^\W\d_][\w-]*",
            rf"(?<!\w)(?:calle|c/|avda?\.?|avenida|plaza|paseo|pza\.|camino|ronda|travesía)\s*(?:[^\W\d_][\w'-]*\s+){{1,5}}?(?:n[ºo°]\.?\s*)?\d{{1,5}}(?:,\s+\d{{1,2}}\.?\s?[ºª°]\s*[a-z]?\b)?(?:,\s+(?:\d{{5}}\s+)?(?!(?:y|no)\b)[^\W\d_][\w-]*)?",
            rf"(?<!\w)(?:ул\.|улица|проспект|пр-т|переулок|пер\.)\s*[^\W\d_][\w-]*(?:\s+[^\W\d_][\w-]*)?,?\s+(?:д\.|дом)?\s*\d+(?:,?\s*кв\.\s*\d+)?",
        ]
    ),
    _I,
)

# Family names. Two-syllable ones first.
_KO_FAMILY = (
    "남궁|황보|제갈|선우|독고|사공|서문|동방|망절|"
    "[김이박최정강조윤장임한오서신권황안송류전홍고문양손배백허유남심노하곽성차주우구나민진지엄채원천방공현함변염여추도소석선설마길연위표명기반왕금옥육인맹제모국어은편용]"
)
_ZH_DOUBLE = "欧阳|东方|南宫|上官|司马|诸葛|西门|慕容|司徒|令狐|皇甫|尉迟|公孙|长孙|端木|夏侯"
_KO_NAME = rf"(?:(?:{_KO_FAMILY})\s?[가-힣]{{2}}|[a-z]{{2,10}}\s+[a-z]{{2,8}}-[a-z]{{2,8}})"
_WORD = r"[^\W\d_][^\W\d_'’]*(?:[-'’][^\W\d_]+)*"
_WEST = rf"(?:{_WORD},\s+{_WORD}|(?:{_WORD}|[^\W\d_]\.)\s+(?:[^\W\d_]\.\s*)?{_WORD})"
_ZH_NAME = rf"(?:(?:{_ZH_DOUBLE})[{_HAN}]{{1,2}}|(?!{_ZH_DOUBLE})[{_HAN}]{{2,3}})"
_JA_NAME = rf"(?:[{_HAN}々]{{2,3}}[ \u3000]?[{_HAN}々]{{1,3}}[ぁ-ん]{{0,2}}|[ァ-ヶー]+[・＝ \u3000][ァ-ヶー]+(?:[・＝ \u3000][ァ-ヶー]+)?)"
_NOBODY = r"(?!(?:the|a(?!\.)|an|my|our|their|his|her|your|its|this|that|mr|mrs|ms|dr|staff|people|one)\b)"
_PERSON = re.compile(
    "|".join(
        [
            rf"(?:성명|성함|이름)\s*(?:[:：]|은|는)?\s*({_KO_NAME})(?=\s*(?:[/,.]|이고|이며|입니다|이에요|예요|$))",
            rf"(?:담당자|담당|직원|기사)\s+({_KO_NAME})\s*(?:씨|님)",
            rf"(?<![가-힣])({_KO_NAME})(?<![와과요를을])\s*(?:상담사|점장|매니저|사원|대리|과장|팀장|부장|주임|기사|원장|간호사|선생|교수|씨)(?:님|를|을|이|가|은|는|께|\s)",
            rf"(?:저는|제가|나는)\s+({_KO_NAME})(?=\s*이?(?:라고|라는|입니다|예요|에요))",
            rf"\bmy\s+name\s+is\s+({_WEST})(?=\s+(?:and|from)\b|[.,!?]|\s*$)",
            rf"\bi\s+am\s+({_WEST})(?=\s+and\s+i\b)",
            rf"\b(?:contact|name):\s+({_WEST})(?=\s*[,/])",
            rf"(?<![\w.])(?<!mrs\. )(?<!mr\. )(?<!dr\. ){_NOBODY}({_WEST})(?=\s+at\s+the\s+desk\b)",
            rf"\bthanks\s+to\s+{_NOBODY}({_WEST})(?=\s+(?:the|a|my|our)\b)",
            rf"\b(?:frau|herrn?)\s+(?:dr\.\s+|prof\.\s+)*({_WEST})(?=\s+(?:hat|war|ist|wurde|konnte)\b)",
            rf"\bich\s+(?:bin|heiße)\s+({_WEST})(?=\s+und\b|[.,!?])",
            rf"\b(?:me\s+atendió|me\s+llamo|mi\s+nombre\s+es)\s+({_WEST})(?=\s+(?:con|y)\b|[.,!?])",
            rf"(?:担当|店長|係|スタッフ|店員)の({_JA_NAME})(?=さん|様|氏)",
            rf"(?:氏名|お名前|名前)\s*[：:は]\s*({_JA_NAME})(?=[、,。です]|$)",
            rf"(?:联系|客服|店员|经理|顾问|找)({_ZH_NAME})(?=先生|女士|小姐|老师)",
            rf"(?:姓名|名字)\s*[：:是]\s*({_ZH_NAME})(?=[，,。]|$)",
            rf"我(?:叫|是)({_ZH_NAME})(?=[，。])",
            r"(?:г-н|г-жа|господин|госпожа|меня\s+зовут)\s+([а-яё]\.\s*(?:[а-яё]\.\s*)?[а-яё-]+|[а-яё]+\s+[а-яё]\.\s*[а-яё-]+)",
        ]
    ),
    _I,
)
# Names by their shape: capital words of Latin script anywhere, kept where the shape itself or a word beside
# it speaks of a person and none of their words is one of places, firms or ordinary speech. Texts all in
# capitals have no shapes, so only words of talking and of staff (group 4) count there.
_UP = "A-ZÀ-ÖØ-Þ"
_CAPITAL = rf"[{_UP}][^\W\d_]+(?:[-'’][^\W\d_]+)*"
_FULL = rf"(?:{_CAPITAL},\s+{_CAPITAL}|(?:{_CAPITAL}|[{_UP}]\.)\s+(?:[{_UP}]\.\s*)?{_CAPITAL})"
_SHAPE = re.compile(
    "|".join(
        [
            rf"(?<![\w.&'’-])(?<!z\. )([{_UP}]\.\s+(?:[{_UP}]\.\s*)?{_CAPITAL})",
            rf"(?<![\w.&'’-])([{_UP}]{{3,}}(?:[-'’][{_UP}]{{2,}})*,\s+[{_UP}][^\W\d_{_UP}]+)(?![\w,])",
            rf"\b(?i:mr|mrs|ms|miss|dr|prof|sr|sra|señora?|doña|frau|herrn?|madame|monsieur)\b\.?\s+({_FULL})",
            r"\b(?i:asked|ask(?:ed|ing)?\s+for|look(?:ed|ing)?\s+for|told|called|phoned|e-?mailed|contacted|messaged|texted|met(?:\s+with)?|thank(?:ed)?|(?:spoke|speak|speaking|talked|talk|talking|chatted)\s+(?:to|with)"
            r"|(?:helped|served|assisted|advised|greeted|treated|welcomed)\s+by|named|colleague|employee|clerk|cashier|manager|assistant|waiter|waitress|nurse|teacher|driver"
            rf"|consultant|advisor|adviser|agent|technician|representative|regards,|sincerely,|my\s+name\s+is|thanks\s+to|(?:sprach|spreche|sprechen|redete|telefonierte)\s+mit|pregunté\s+a|(?:hablé|habló|hablar)\s+con|llamé\s+a)\s+({_FULL})",
            rf"(?<![\w.&'’-])({_FULL})(?=\s+(?:who|helped|served|greeted|smiled|explained|assisted|advised)\b)",
        ]
    )
)
_NO_NAMES = frozenset(
    "the a an i it he she we you they this that these those there here my our your his her their its and but or so if when while then as at by for from in of on to with after before since because "
    "yes no not ok okay please thanks well what why how who where which all any some one two three also just only still even maybe perhaps usually personally overall honestly "
    "inc ltd llc plc corp co company group gmbh ag kg bank mills store stores shop market mall center centre hotel airport station school university college hospital clinic church park hill hills street st road rd avenue ave "
    "lane square bridge river lake city town valley beach north south east west new san santa los las el la saint customer service support team staff desk office department help center management app "
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december "
    "mr mrs ms miss dr prof frau herr herrn señor señora sr sra u.s u.k der die das ein eine und oder ich wir sie er es bei beim zum zur im in am mit von nach thema punkt stichwort sachen "
    "el los las un una y o pero en con por para que de del al".split()
)


def _is_name(words: str) -> bool:
    return not any(w.casefold() in _NO_NAMES for w in re.findall(r"[^\W\d_]+", words)) and bool(re.search(r"[^\W\d_]{3}", words))


#: Cheap signs that a text may hold a mention at all.
_CAPITALS = re.compile(rf"[{_UP}](?:\.|[^\W\d_]+,?)\S*\s+[{_UP}]")
_FIRM = re.compile(r"\s+(?:Inc|Ltd|LLC|GmbH|AG|Corp|Co|Hill|Mills|Street|Road|Square)\b")
_DIGITS = re.compile(r"\d{3}|[x*]{3}-|공일", _I)
_HELP = re.compile("도와|안내|설명해|응대|상담해|알려|챙겨")
_PLACE = re.compile(r"\d")
_CUE = re.compile(
    r"성명|성함|이름|담당|직원 |기사|상담사|점장|매니저|사원|대리|과장|팀장|부장|주임|원장|간호사|선생|교수|씨|저는|제가|나는|name|i am|contact|desk|thanks|frau|herr|ich |atendió|llamo|nombre|担当|店長|係|スタッフ|店員|氏名|名前|联系|客服|店员|经理|顾问|找|姓名|名字|我叫|我是|г-н|г-жа|госпо|зовут",
    _I,
)


def _valid_birthday(digits: str, sex: str = "*") -> bool:
    """Whether the six digits are a day of the century that the seventh tells, or of either where that is masked."""
    for century in (1900, 2000) if sex not in "12345678" else (2000,) if sex in "3478" else (1900,):
        try:
            date(century + int(digits[:2]), int(digits[2:4]), int(digits[4:6]))
            return True
        except ValueError:
            pass
    return False


#: Numbers after such a word are no personal data.
_NOT_MINE = re.compile(
    r"(?:\b(?:orders?|invoices?|tickets?|ref(?:erence)?|tracking|parcels?|bookings?|receipts?|case|bestell\w*|auftrag\w*|rechnung\w*|sendung\w*|pedidos?|facturas?|reserva)|주문|송장|예약|접수|영수증|订单|发票|运单|注文|予約|заказ\w*)"
    r"\s*(?:번호|号|番号|nummer|number|no\.?|nr\.?|n[ºo°]\.?)?\s*(?:[:：#]|is|was|은|는|は|是|:)?\s*#?\s*$",
    _I,
)
#: Ten digits in a row are a phone number where a word of calling stands before them.
_CALL = re.compile(r"\b(?:call|phone|telephone|tel|text|reach|ring|dial|mobile|cell|whatsapp)\b[^\d\n]{0,24}?(?<![\d+-])(1?[2-9]\d{2}[2-9]\d{6})(?![\d-])", _I)
#: Korean names without a title, before what somebody did for the writer.
_KO_DID = re.compile(rf"(?<![가-힣])((?:{_KO_FAMILY})[가-힣]{{2}})(?:이|가|께서|님이|님께서)\s+(?:너무\s+|정말\s+|아주\s+|잘\s+|매우\s+|친절(?:하게|히)\s+)*(?:도와|안내|설명해|응대|상담해|알려|챙겨)")


def find(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, plain value) of every mention, in the order of the text; none overlap. Kinds are
    sought in the order email, id_number, phone, address, person; an earlier kind keeps its place."""
    if not text:
        return []
    plain, at = shadow(text)
    found: list[tuple[str, int, int, str]] = []
    taken: list[tuple[int, int]] = []

    def take(kind: str, a: int, b: int) -> None:
        if all(b <= x or y <= a for x, y in taken):
            taken.append((a, b))
            found.append((kind, a if at is None else at[a], b if at is None else at[b], plain[a:b]))

    if "@" in plain or "at)" in plain.lower() or "at]" in plain.lower() or "골뱅이" in plain:
        for m in _EMAIL.finditer(plain):
            take("email", *m.span())
    if _DIGITS.search(plain):
        for m in _ID.finditer(plain):
            birthday = m.group("rrn") or m.group("rrn2")
            if birthday is None or _valid_birthday(birthday, re.sub(r"[ –-]", "", m.group())[6]):
                if not _NOT_MINE.search(plain, max(0, m.start() - 40), m.start()):
                    take("id_number", *m.span())
        numbers = [m.span() for m in _PHONE.finditer(plain) if not _NOT_MINE.search(plain, max(0, m.start() - 40), m.start())] + [m.span(1) for m in _CALL.finditer(plain)]
    else:
        numbers = [m.span() for m in _PHONE.finditer(plain)] if "공일" in plain else []
    if _PLACE.search(plain):
        for m in _ADDRESS.finditer(plain):
            take("address", *m.span())
    for span in numbers:
        take("phone", *span)
    if _CUE.search(plain):
        for m in _PERSON.finditer(plain):
            take("person", *m.span(m.lastindex))
    if _HELP.search(plain):
        for m in _KO_DID.finditer(plain):
            take("person", *m.span(1))
    if _CAPITALS.search(plain):
        for m in _SHAPE.finditer(plain):
            a, b = m.span(m.lastindex)
            if _is_name(plain[a:b]) and not _FIRM.match(plain, b) and (m.lastindex == 4 or not plain.replace("ß", "").isupper()):
                take("person", a, b)
    found.sort(key=lambda x: x[1])
    return found


# --- pseudonyms --------------------------------------------------------------------------------------


def feistel(values: list[int], radix: int, key: bytes, tweak: str, rounds: int = 10) -> list[int]:
    """A keyed permutation of the strings of this length over `radix` signs: an alternating Feistel
    network whose round function is HMAC-SHA256 of the tweak, the round and the other half."""
    n = len(values)
    if n < 2:
        shift = int.from_bytes(hmac.new(key, f"{tweak}|{radix}".encode(), hashlib.sha256).digest()[:8], "big")
        return [(v + shift) % radix for v in values]
    half = n // 2
    as_number = lambda digits: sum(d * radix**i for i, d in enumerate(digits))
    a, b = as_number(values[:half]), as_number(values[half:])
    sizes = (radix**half, radix ** (n - half))
    for r in range(rounds):
        if r % 2 == 0:
            a = (a + _round(key, tweak, r, n, b)) % sizes[0]
        else:
            b = (b + _round(key, tweak, r, n, a)) % sizes[1]
    out = []
    for number, length in ((a, half), (b, n - half)):
        for _ in range(length):
            number, digit = divmod(number, radix)
            out.append(digit)
    return out


def _round(key: bytes, tweak: str, r: int, n: int, other: int) -> int:
    return int.from_bytes(hmac.new(key, f"{tweak}|{r}|{n}|{other}".encode(), hashlib.sha256).digest(), "big")


_FIRST_DAY, _DAYS = date(1900, 1, 1), 36525


def permute_date(day: date, key: bytes) -> date:
    """A keyed permutation of the days of a century: a Feistel walk over 0..2^16 that is followed until it
    falls on a day again."""
    number = (day - _FIRST_DAY).days
    while True:
        bits = feistel([(number >> i) & 1 for i in range(16)], 2, key, "date")
        number = sum(bit << i for i, bit in enumerate(bits))
        if number < _DAYS:
            return _FIRST_DAY + timedelta(days=number)


def _spelled(value: str) -> str:
    return value.translate(str.maketrans("공영일이삼사오육칠팔구", "00123456789"))


def canonical(kind: str, value: str) -> str:
    """The form in which equal values are the same string."""
    if kind == "phone":
        digits = re.sub(r"\D", "", re.sub(r"(?i)\s*(?:ext\.?|x)\s*\d+$", "", _spelled(value)))
        for code in ("0082", "82", "0081", "81", "0049", "49", "0044", "44"):
            if (value.lstrip().startswith("+") or code.startswith("00")) and digits.startswith(code):
                return "0" + digits[len(code) :].lstrip("0")
        for code in ("86", "34", "1"):
            if value.lstrip().startswith("+") and digits.startswith(code):
                return digits[len(code) :]
        return digits[1:] if len(digits) == 11 and digits[0] == "1" and value.startswith("1-") else digits
    if kind == "id_number":
        return re.sub(r"[^0-9A-Za-z*]", "", value).upper().replace("X" * 3 + "X" * 2, "*" * 5)
    if kind == "email":
        value = re.sub(r"(?i)\s*[(\[{]\s?(?:at|골뱅이)\s?[)\]}]\s*", "@", value)
        value = re.sub(r"(?i)\s*[(\[{]\s?dot\s?[)\]}]\s*", ".", value)
        return re.sub(r"\s", "", value).lower()
    if kind == "person":
        if "," in value:
            last, first = value.split(",", 1)
            value = f"{first} {last}"
        return re.sub(r"\s+", "" if re.search(r"[가-힣一-鿿]", value) else " ", value.strip()).casefold()
    return re.sub(r"[\s,.]+", " ", value).strip().casefold()


_SIGNS = "abcdefghijkmnpqrstuvwxyz23456789"


def _laid_out(value: str, signs: str) -> str:
    """`signs` in the places of the letters, digits and masks of `value`, everything else as it stands there."""
    left = iter(signs)
    return "".join(next(left) if c.isalnum() or c in "*●" else c for c in value)


def pseudonym(kind: str, value: str, key: bytes) -> str:
    """The placeholder of a value, such as <phone 010-4471-9023> or <person ktw5q8zd>."""
    form = canonical(kind, value)
    own = "".join(c for c in value if c.isalnum() or c in "*●")
    if kind == "id_number" and re.fullmatch(r"\d{6}[1-8]\d{6}", form) and _valid_birthday(form, form[6]):
        century = 2000 if form[6] in "3478" else 1900
        day = permute_date(date(century + int(form[:2]), int(form[2:4]), int(form[4:6])), key)
        rest = "".join(map(str, feistel([int(d) for d in form[7:]], 10, key, form[6])))
        sex = (int(form[6]) % 2 or 2) + (2 if day.year >= 2000 else 0) + (4 if form[6] in "5678" else 0)
        return f"<{kind} {_laid_out(value, f'{day:%y%m%d}{sex}{rest}')}>"
    if kind in ("phone", "id_number"):
        # the lead digits of a phone number tell what network it is in, not whose it is
        lead = 3 if kind == "phone" and len(form) >= 9 else 0
        digits = iter(feistel([int(c) for c in form[lead:] if c.isdigit()], 10, key, f"{kind}|{form[:lead]}|{len(form)}"))
        signs = form[:lead] + "".join(str(next(digits)) if c.isdigit() else c for c in form[lead:])
        if len(own) == len(signs) and own.isascii():
            return f"<{kind} {_laid_out(value, signs)}>"
        return f"<{kind} {signs}>"  # a notation of another length, as with a country's code or in words
    code = hmac.new(key, f"{kind}|{form}".encode(), hashlib.sha256).digest()
    return f"<{kind} {''.join(_SIGNS[b % 32] for b in code[:12])}>"


def replace(text: str | None, key: bytes) -> str | None:
    """The text with each mention replaced by its placeholder and everything else unchanged."""
    mentions = find(text)
    if not mentions:
        return text
    out, last = [], 0
    for kind, a, b, value in mentions:
        out += [text[last:a], pseudonym(kind, value, key)]
        last = b
    return "".join(out) + text[last:]


# --- operators ---------------------------------------------------------------------------------------


def find_mentions(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind, start_pos, end_pos): one row per mention, positions in code points from 0.

    A null or empty text has none; keys pass through as they are, null and repeated ones too; other columns
    play no part. Texts of any length are searched whole."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("kind", T.StringType()), T.StructField("start_pos", T.LongType()), T.StructField("end_pos", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kinds, starts, ends = [], [], [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                for kind, a, b, _ in find(value):
                    rows.append(i)
                    kinds.append(kind)
                    starts.append(a)
                    ends.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=[key, "kind", "start_pos", "end_pos"])

    return spread(df.select(F.col(key), F.col(text).cast("string"))).mapInArrow(run, schema)


def replace_mentions(df: DataFrame, key: str, text: str, secret: str) -> DataFrame:
    """(key, redacted): every row's text with placeholders in place of personal data; null stays null.
    `secret` keys the pseudonyms; one secret links equal values across all documents of all runs, and whoever has it can
    tell what stands behind a number. An empty secret is a ValueError."""
    if not secret:
        raise ValueError("pseudonyms need a secret")
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("redacted", T.StringType())])
    secret_key = secret.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [replace(value, secret_key) for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.string())], names=[key, "redacted"])

    return spread(df.select(F.col(key), F.col(text).cast("string"))).mapInArrow(run, schema)
