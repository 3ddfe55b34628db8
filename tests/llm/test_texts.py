import re
import time
import unicodedata

import pytest
from helpers import odd_characters
from hypothesis import given, settings
from hypothesis import strategies as st

from respondo.llm import encode, lookalikes, personal, sentences
from respondo.llm.perfect_hash import PerfectHash

# --- encoding


@pytest.fixture(scope="module")
def encoder():
    return encode.Encoder(encode.read_ranks(encode.default_vocabulary()))


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_perfect_hash_holds_every_key_and_no_other():
    keys = [f"k{i}".encode() for i in range(5000)]
    table = PerfectHash(keys, list(range(5000)))
    assert table.lookup(keys).tolist() == list(range(5000))
    assert (table.lookup([f"x{i}".encode() for i in range(500)]) == -1).all()
    assert None not in table.keys
    assert PerfectHash([], []).lookup([b"a"]).tolist() == [-1]
    with pytest.raises(ValueError):
        PerfectHash([b"a", b"a"], [1, 2])


def test_whole_table_as_the_library_encodes_it(spark, data, reference):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = {r.doc_id: r.ids for r in encode.encode_documents(docs.withColumn("ids", docs.text)).collect()}
    assert found == {r.doc_id: reference(r.text or "") for r in docs.collect()}


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(encoder, reference, text):
    assert encoder.encode([text])[0] == reference(text)


def test_special_strings_and_long_words(encoder, reference):
    for text in ["<|endoftext|>", "a" * 30_000, "가" * 5_000, " \n\n\t x", "don't I'll 'S"]:
        assert encoder.encode([text])[0] == reference(text)


def test_long_word_takes_no_quadratic_time(encoder):
    began = time.time()
    encoder.encode(["xyzzy" * 60_000])
    assert time.time() - began < 20


def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "a"), (2, "")], "doc_id bigint, text string")
    assert sorted(((r.doc_id, r.ids) for r in encode.encode_documents(df).collect()), key=str) == sorted([(1, []), (2, []), (None, [64]), (2, [])], key=str)
    assert encode.encode_documents(df.limit(0)).count() == 0
    assert {(r.doc_id, r.n_tokens) for r in encode.count_tokens(df, ["doc_id"]).collect()} == {(1, 0), (2, 0), (None, 1)}


# --- look-alikes

CASES = [
    ("Orbеx의", "Orbex의", True), ("Ｉ am ２", "I am 2", True), ("👩‍💻 ok", "👩‍💻 ok", False), ("승차감‌이", "승차감이", True),
    (unicodedata.normalize("NFD", "한글 é"), "한글 é", True), ("ﾊﾟﾋﾌﾞ", "パヒブ", True), ("ひかり、！？（あ）", "ひかり、！？（あ）", False), ("⼀番", "一番", True),
    ("а и о, да", "а и о, да", False), ("Тһе end", "The end", True), ("㈜ ① º “x”", "㈜ ① º “x”", False), ("стaла", "стала", True), ("日本　語", "日本　語", False),
    ("a\xa0b", "a b", True), ("a b", "a b", True), ("𝐀bc", "Abc", True), ("ﬁne", "fine", True), ("क्‍ष", "क्‍ष", False), ("", "", False), (None, None, False), ("Ω мир", "Ω мир", False),
]


def test_one_form(spark):
    df = spark.createDataFrame([(i, t, True) for i, (t, *_) in enumerate(CASES)], "key int, text string, changed boolean")
    found = {r.key: (r.canonical, r.changed) for r in lookalikes.canonical_text(df, "key", "text").collect()}
    assert found == {i: (c, x) for i, (_, c, x) in enumerate(CASES)}
    assert lookalikes.canonical_text(df.limit(0), "key", "text").count() == 0


def test_rows_found_as_by_a_plainer_rule(spark, data):
    df = spark.read.parquet(f"{data}/grammar_records.parquet")
    found = {r.key for r in lookalikes.canonical_text(df, "record_id", "corrected").where("changed").collect()}
    texts = {r.record_id: r.corrected for r in df.collect()}
    surely = {i for i, t in texts.items() if t and odd_characters(t)}
    assert surely <= found and len(found - surely) <= 0.02 * len(texts)


def test_form_is_stable(spark, data):
    df = spark.read.parquet(f"{data}/grammar_records.parquet")
    once = lookalikes.canonical_text(df, "record_id", "corrected").select("key", "canonical")
    assert lookalikes.canonical_text(once, "key", "canonical").where("changed").count() == 0


# --- personal data

MENTIONS = [
    ("제 번호는 010-0073-7500 입니다.", [("phone", 6)]), ("담당자 김여람 씨와 +82 10-0789-5513 번호로", [("person", 4), ("phone", 11)]), ("환불은 공일공 공오삼구 오이이삼 쪽", [("phone", 4)]),
    ("주민번호 030608 - 1000077 오류", [("id_number", 5)]), ("쓴 250610-3****** 번호", [("id_number", 2)]), ("주문번호 2031-0372-5567 조회", []), ("영수증에 2031.07.16 날짜", []), ("가격 1.300,50 Euro", []),
    ("Call (202) 555-0166 now", [("phone", 5)]), ("number 906 02 0601 twice", [("id_number", 7)]), ("XXX-XX-2837 twice", [("id_number", 0)]), ("Order 2051-0372-5567 shows", []),
    ("Mail wiebke (at) example.com or A@B.ORG로", [("email", 5), ("email", 32)]), ("a_marlow[at]sub[dot]example[dot]org", [("email", 0)]),
    ("We live at 76 W. Kestrel St., Apt. 7B, Penwick, 00024 and", [("address", 11)]), ("opposite P.O. Box 3138, Eastmere has", [("address", 9)]), ("asked 9 times about the court ruling", []),
    ("배송지는 온누리시 두루구 바람골로 47길 22 입니다.", [("address", 5)]), ("솔마을에서 4명이 참여", []), ("住所は〒000-0041 空野市月見7丁目65番地です", [("address", 3)]), ("地址是沐川市星渡区桂影路89号9栋", [("address", 3)]),
    ("Wir wohnen: Am Alten Ahornmoor 82, 00494 Quellbrunn.", [("address", 12)]), ("Vivo en Avda. de la Encinar 11, 00292 Riofresno y no", [("address", 8)]),
    ("Dr. Marvane from the branch", []), ("Mr. and Mrs. Ashgrove like", []), ("Thanks to J. Toldell the", [("person", 10)]), ("Frau L. Brenndorfer hat mir", [("person", 5)]), ("Me atendió SIERRAVERDE, Marcia con", [("person", 11)]),
    ("担当の鳴島悠里さんが", [("person", 3)]), ("担当の鳴島さんが", []), ("请联系欧阳语渡先生", [("person", 3)]), ("客服虞女士", []), ("El DNI X-0041279-C no", [("id_number", 7)]), ("Meine Steuernummer 00 778 133 433 wurde", [("id_number", 19)]),
    ("성명: 노‌빛겸 / 연락처: ０10 0219 2650.", [("person", 4), ("phone", 16)]), ("", []), (None, []),
]


@pytest.mark.parametrize("text,expected", MENTIONS)
def test_mentions(text, expected):
    assert [(kind, a) for kind, a, _, _ in personal.find(text)] == expected


def test_mention_rows(spark):
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(MENTIONS)], "record_id int, corrected string, kind string")
    found = sorted((r.record_id, r.kind, r.start_pos) for r in personal.find_mentions(df, "record_id", "corrected").collect())
    assert found == sorted((i, k, a) for i, (_, e) in enumerate(MENTIONS) for k, a in e)
    assert personal.find_mentions(df.limit(0), "record_id", "corrected").count() == 0


def test_placeholders_link_equal_values_and_leave_the_rest():
    key = b"secret"
    a = personal.replace("내 번호 010-0283-9973, 끝.", key)
    b = personal.replace("또 01002839973!", key)
    kept, bare = re.search(r"<phone (010-\d{4}-\d{4})>", a)[1], re.search(r"<phone (010\d{8})>", b)[1]
    assert kept.replace("-", "") == bare  # the same number, each in its own notation
    assert a.startswith("내 번호 <") and a.endswith(">, 끝.") and "9973" not in re.sub(r"<[^>]*>", "", a)
    assert personal.replace("Mail A@B.org", key)[5:] == personal.replace("a (at) b.ORG", key)
    assert personal.replace("number 906 02 0601 twice", b"other") != personal.replace("number 906 02 0601 twice", key)
    assert personal.replace(None, key) is None and personal.replace("nothing", key) == "nothing"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=4))
def test_feistel_keeps_length_and_digits(digits):
    out = personal.feistel(digits, 10, b"k", "t")
    assert len(out) == len(digits) and all(0 <= d < 10 for d in out)


def test_feistel_is_a_permutation():
    assert len({tuple(personal.feistel([a, b, c], 10, b"k", "t")) for a in range(10) for b in range(10) for c in range(10)}) == 1000
    from datetime import date, timedelta

    days = [date(1950, 1, 1) + timedelta(days=i) for i in range(400)]
    assert len({personal.permute_date(d, b"k") for d in days}) == 400
    assert re.fullmatch(r"<id_number \d{3}-\d\d-\d{4}>", personal.pseudonym("id_number", "123-45-6789", b"k"))
    assert re.fullmatch(r"<id_number \d{3}-\*\*-\d{4}>", personal.pseudonym("id_number", "123-**-6789", b"k"))
    assert personal.pseudonym("phone", "+82 10-1234-5678", b"k")[7:-1] == re.sub(r"\D", "", personal.pseudonym("phone", "010 1234 5678", b"k"))
    found = re.search(r"(\d\d)(\d\d)(\d\d)-", personal.pseudonym("id_number", "030608-1000077", b"k"))
    assert 1 <= int(found[2]) <= 12 and 1 <= int(found[3]) <= 31


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Maria Lopez helped me a lot.", [("person", 0)]), ("I spoke to Maria Lopez about it.", [("person", 11)]), ("Ask for John Smith.", [("person", 8)]), ("홍길동이 도와줬어요", [("person", 0)]),
        ("order 912345678 arrived", []), ("주문번호 912345678 조회", []), ("my itin 912345678", [("id_number", 8)]), ("Call me at 2125550147", [("phone", 11)]), ("order no. 010-1234-5678", []),
        ("900230-1234567", []), ("900228-1234567", [("id_number", 0)]), ("000229-3234567", [("id_number", 0)]), ("010229-3234567", []),
    ],
)
def test_mentions_in_other_frames(text, expected):
    assert [(k, a) for k, a, *_ in personal.find(text)] == expected


def test_a_secret_is_demanded(spark):
    df = spark.createDataFrame([(1, "a@b.org")], "record_id int, corrected string")
    with pytest.raises(ValueError):
        personal.replace_mentions(df, "record_id", "corrected", "")


# --- sentences


@pytest.fixture(scope="module")
def model(spark):
    analysed = spark.read.parquet("/root/testdata/sf0.01/sentence_analysis.parquet")
    return sentences.fit_model(analysed, "analysis_id", "automic_sentence")


def parts(model, text):
    begin, out = 0, []
    for end in sentences.sentence_ends(model, text):
        out.append(text[begin:end].strip())
        begin = end
    return out


SPLITS = [
    ["Dr. Marvane from the branch praised the discount offer, e.g. the small details!!", "Why did the menu change?"], ["They closed at 7 p.m.", "To be fair, the design was a letdown..."],
    ['"Why is the app screen like this?" my sister asked.', "After 3 years I still trust the price."], ["（例如支付方式。）这种写法看不懂。", "说实话，价格没有达到预期！"], ["「デザインは良い。でも高い。」と友人が言っていました。", "No.3の店は配送が一番です♪。"],
    ["“앱 화면은 좋다. 그런데 비싸다.”라는 말을 자주 들었습니다.", "No.7 매장의 진열이 제일 나아요!"], ["구매처=보통 | 가격=비쌈 | 총평=적당함"], ["좋음"],
]


@pytest.mark.parametrize("expected", SPLITS)
def test_splits(model, expected):
    glue = "" if re.search("[。！♪]$", expected[0]) else " "
    assert parts(model, glue.join(expected)) == expected
    assert parts(model, "\n".join(expected)) == expected


def test_korean_without_end_marks(model):
    assert parts(model, "가격은 생각보다 괜찮았습니다 솔직히 포장은 기대에 못 미쳤어요") == ["가격은 생각보다 괜찮았습니다", "솔직히 포장은 기대에 못 미쳤어요"]


def test_thai_without_periods(model):
    assert parts(model, "เมื่อวาน ลองใช้แล้ว ราคายังไม่ค่อยดีค่ะ ถ้าเวลารอดีกว่านี้ จะกลับมาซื้ออีกครับ") == ["เมื่อวาน ลองใช้แล้ว ราคายังไม่ค่อยดีค่ะ", "ถ้าเวลารอดีกว่านี้ จะกลับมาซื้ออีกครับ"]


def test_positions_are_those_of_the_stored_text(model):
    text = " Why did the me​nu change?  Honestly, the taste was a letdown. "
    ends = sentences.sentence_ends(model, text)
    assert [text[:e][-1] for e in ends] == ["?", "."]


def test_held_out_accuracy(spark):
    answers = [[s for s in r.automic_sentence if s] for r in spark.read.parquet("/root/testdata/sf0.01/sentence_analysis.parquet").orderBy("analysis_id").collect() if r.automic_sentence]
    fitted = sentences.BoundaryModel.fit(answers[:1500])
    held = [[s.strip() for s in a if s.strip()] for a in answers[1500:]]
    good = sum(parts(fitted, "\n".join([" ".join(a)])) == a for a in held if not any("\n" in s for s in a))
    assert good >= 0.9 * len(held)


def test_posteriors_are_those_of_all_boundary_choices(model):
    from itertools import product
    from math import isclose, prod

    words = [model.number(f) for f, *_ in sentences.tokens("가격은 좋다 . 포장은 괜찮았습니다")]
    n = len(words)

    def weight(events):  # the product of all steps, event i after word i, none before the first and after the last
        total = 1.0
        for i in range(n - 1):
            u = 0 if i == 0 or events[i - 1] else words[i - 1]
            v, w = words[i], words[i + 1]
            total *= model.p(u, v, 0) * model.p(v, 0, w) if events[i] else model.p(u, v, w)
        u = 0 if n > 1 and events[n - 2] else words[n - 2]
        return total * model.p(u, words[n - 1], 0)

    weights = {e: weight(e) for e in product((0, 1), repeat=n - 1)}
    whole = sum(weights.values())
    found = model.posteriors(words, [True] * (n - 1) + [False])
    for i in range(n - 1):
        assert isclose(found[i], sum(w for e, w in weights.items() if e[i]) / whole, rel_tol=1e-6)
    assert prod([1.0]) == 1.0


def test_sentence_rows(spark, model):
    df = spark.createDataFrame([(1, "Why did the menu change? Honestly, the taste was a letdown."), (2, None), (3, " "), (4, ""), (4, "ok"), (None, "ok")], "record_id bigint, corrected string")
    df = df.withColumn("end_pos", df.record_id)
    assert sorted(((r.record_id, r.ordinal, r.start_pos, r.end_pos) for r in sentences.split_documents(df, "record_id", "corrected", model).collect()), key=str) == sorted(
        [(1, 0, 0, 24), (1, 1, 25, 59), (4, 0, 0, 2), (None, 0, 0, 2)], key=str
    )
    assert sentences.split_documents(df.limit(0), "record_id", "corrected", model).count() == 0
    long = "Why did the menu change? " * 4000
    assert len(sentences.sentence_ends(model, long)) == 4000


def test_model_comes_from_every_analysed_answer(spark):
    """More answers than the sample of 60,000 that it was once fitted on; what is told by few of them counts too."""
    common = spark.range(70_000).selectExpr("id as analysis_id", "array('All fine.', null) as automic_sentence")
    rare = spark.range(2).selectExpr("id + 70000 as analysis_id", "array('Zebras ate grass.', 'All fine!') as automic_sentence")
    fitted = sentences.fit_model(common.unionByName(rare), "analysis_id", "automic_sentence")
    assert "zebras" in fitted.ids
    plain = sentences.BoundaryModel.fit([["All fine."]] * 70_000 + [["Zebras ate grass.", "All fine!"]] * 2)
    for u, v, w in (("</s>", "all", "fine"), ("fine", ".", "</s>"), ("zebras", "ate", "grass"), ("</s>", "all", "grass"), ("grass", "</s>", "all")):
        assert fitted.p(*map(fitted.number, (u, v, w))) == pytest.approx(plain.p(*map(plain.number, (u, v, w))), rel=1e-12)


def test_pieces_of_a_line_are_its_tokens(monkeypatch):
    """Remembered pieces lie where the tokens of the whole line do, also when few are remembered."""
    monkeypatch.setattr(sentences, "_PIECES", 3)
    for line in ("It is  ... fine ...", "a\t...b ....", "write a [at] b.com or x@y.org ,ok", "see ab/cd.py 1.5 ½ ๑๒", "漢字カナ ไทยสวัสดีครับ '품질' 좋다.", " x ", "ŉ İx"):
        places = [m.span() for m in sentences._TOKEN.finditer(line)]
        found = sentences.tokens(line)
        assert {b for _, b in places} <= {b for _, _, b, _ in found} and {a for a, _ in places} <= {a for _, a, _, _ in found}
        assert len(found) == len(places) + sum(b - a > 6 and sentences._TOKEN.match(line, a).lastgroup == "thai" for a, b in places)
    assert len(sentences._seen) <= 3


def test_answers_of_the_sentence_model_are_read_once(spark, data):
    """The whole table, each row once, gives the model that a fit in memory gives."""
    analysed = spark.read.parquet(f"{data}/sentence_analysis.parquet").select("analysis_id", "automic_sentence")
    answers = [[s for s in r.automic_sentence if s] for r in analysed.collect() if r.automic_sentence]
    passed = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    fitted = sentences.fit_model(analysed.mapInArrow(watch, analysed.schema), "analysis_id", "automic_sentence")
    assert passed.value == analysed.count()
    plain = sentences.BoundaryModel.fit(answers)
    named = lambda m: {(*divmod(k // m.size, m.size), k % m.size): n for k, n in m.three.items()}
    words = {m: {i: f for f, i in m.ids.items()} for m in (fitted, plain)}
    of = lambda m: {tuple(words[m][i] for i in k): n for k, n in named(m).items()}
    assert fitted.ids.keys() == plain.ids.keys() and len(plain.three) > 100 and of(fitted) == of(plain)


def test_model_of_nothing(spark):
    empty = spark.createDataFrame([], "analysis_id bigint, automic_sentence array<string>")
    fitted = sentences.fit_model(empty, "analysis_id", "automic_sentence")
    assert sentences.sentence_ends(fitted, "one line\nanother") == [8, 16]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("I asked Avna Vendrow for help with the price.", [("person", 8)]), ("I asked BRINDELL, Wrenbin for help.", [("person", 8)]), ("It was fine, W. Hexgrove even called back.", [("person", 13)]),
        ("Ich sprach mit Sighart H. Taller über Sauberkeit.", [("person", 15)]), ("We spoke to Ms. Calna Tolwick on Friday.", [("person", 16)]), ("Later Orbin Toldell explained it.", [("person", 6)]),
        ("I left Ostara Mills because of it.", []), ("It was sold by Pelcon Inc. today.", []), ("In Marlow Hill the first thing", []), ("I asked Customer Service for help.", []), ("Er lobte z. B. Wartezeit sehr.", []),
        ("ICH GEBE 1.7 PUNKTE, D. H. MARKENBILD IST OKAY.", []), ("LA SRA. MONTESCLAROS RECOMENDÓ", []), ("I asked Venley for help.", []),
    ],
)
def test_names_outside_fixed_phrases(text, expected):
    assert [(kind, a) for kind, a, _, _ in personal.find(text)] == expected


def test_sentences_written_on_without_marks_or_spaces_by_script():
    """Analysed answers held out of the fit, their end marks taken away and their sentences written on."""
    import random
    import re

    import pyarrow.parquet as pq

    from respondo.llm.sentences import BoundaryModel, sentence_ends

    lists = pq.read_table("/root/testdata/sf0.1/sentence_analysis.parquet", columns=["automic_sentence"]).column(0).to_pylist()
    answers = [[s for s in a if s and s.strip()] for a in lists if a]
    random.Random(0).shuffle(answers)
    model = BoundaryModel.fit(answers[3000:])
    scripts = {"signs": ("[ぁ-ヿ一-鿿]", ""), "hangul": ("[가-힣]", " "), "latin": ("[A-Za-z]", " ")}
    for script, (letters, between) in scripts.items():
        true = hit = extra = 0
        for a in answers[:3000]:
            bare = [re.sub(r"[\s.!?。！？…♪~～]+$", "", s.strip()) for s in a]
            if len(bare) < 2 or not all(s and re.match(letters, s[-1]) for s in bare[:-1]) or not all(re.match(letters, s[0]) for s in bare[1:] if s):
                continue
            text, ends, at = between.join(bare), set(), 0
            for s in bare[:-1]:
                ends.add(at + len(s))
                at += len(s) + len(between)
            found = set(sentence_ends(model, text)) - {len(text)}
            true, hit, extra = true + len(ends), hit + len(ends & found), extra + len(found - ends)
        print(script, true, hit, extra)
        assert true > 100 and hit >= 0.8 * true and extra <= 0.05 * true
