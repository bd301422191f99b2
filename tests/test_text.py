import re
import unicodedata

from pyspark.sql import functions as F

from claimweave.functions import jsontext, lexicons, numeric, text


def one(spark, value, function):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(function(F.col("v")).alias("r")).first()["r"]


def test_safe_characters_do_not_change_under_nfkc():
    unsafe = re.compile(text.MAY_CHANGE_UNDER_NFKC)
    safe = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and not unsafe.match(chr(c))]
    assert {"a", "é", "क", "्", "ा", "–"} <= set(safe)
    assert [c for c in safe if unicodedata.normalize("NFKC", c) != c] == []
    special = [c for c in safe if unicodedata.combining(c)]
    for first in safe:
        for second in special:
            assert unicodedata.normalize("NFKC", first + second) == first + second


def test_normalize(spark):
    cases = {
        None: "",
        "  A B\n\tC\u001c ": "a b c",
        "ﬁ ① ｱ": "fi 1 ア",
        "ड़ क़": unicodedata.normalize("NFKC", "ड़ क़"),
        "É́tÉ": unicodedata.normalize("NFKC", "É́tÉ").lower(),
    }
    for value, expected in cases.items():
        assert one(spark, value, text.normalize_text) == expected
    assert one(spark, "  a  b\n", text.strip_ws) == "a  b"
    assert one(spark, " A \n b ", text.collapse_ws) == "A b"


def test_nfkc_array_keeps_separators_of_the_data(spark):
    df = spark.createDataFrame([(["a\u0001b", "①", None],), (["x\u0001"],)], "a array<string>")
    found = [r[0] for r in df.select(text.nfkc_array(F.col("a"))).collect()]
    assert sorted(found) == [["a\u0001b", "1", ""], ["x\u0001"]]


def test_nfkc_array(spark):
    df = spark.createDataFrame([(1, ["ﬁ", None, "a"]), (2, []), (3, None)], "i int, a array<string>")
    rows = {r["i"]: r["r"] for r in df.select("i", text.nfkc_array(F.col("a")).alias("r")).collect()}
    assert rows == {1: ["fi", "", "a"], 2: [], 3: []}


def test_tokens_keep_or_split_devanagari_marks(spark):
    assert one(spark, "हिन्दी abc_1", text.token_set) == ["हिन्दी", "abc", "1"]
    expected = re.findall(r"[^\W_]+", "हिन्दी abc_1")
    assert one(spark, "हिन्दी abc_1", text.word_set) == expected


def test_entities(spark):
    def variants(c):
        return text.entity_variants(text.normalize_entity(text.nfkc(c)))

    assert one(spark, "The  Citizenship-Act, (CAA)!", variants) == [
        "the citizenship-act caa", "citizenship-act caa",
    ]
    assert one(spark, "a b c d", variants) == ["a b c d", "c d", "b c d"]
    assert one(spark, "India", variants) == ["india"]
    assert one(spark, " !", variants) == []


def test_important_phrases(spark):
    def brute(value):
        w = [x for x in re.findall(r"[a-zA-ZÀ-ÿऀ-ॿ0-9]+", value) if x not in lexicons.RETRIEVAL_STOPWORDS and len(x) > 2]
        out = []
        for n, least in ((4, 12), (3, 10), (2, 8), (1, 7)):
            for i in range(len(w) - n + 1):
                p = " ".join(w[i : i + n])
                if len(p) >= least and p not in out:
                    out.append(p)
        return out

    for value in ("", "cat", "the flood in kerala killed seventeen people", "a b " * 30, "बाढ़ केरल राहत शिविर सरकार flood flood flood flood"):
        assert one(spark, value, lambda c: text.important_phrases(c, 15)) == brute(value)[:15]
        assert one(spark, value, text.important_phrases) == brute(value)


def test_truncation_and_digits(spark):
    assert one(spark, "abcdefghij", lambda c: text.truncate_middle(c, 4)) == "ab\n...[TRUNCATED]...\nij"
    assert one(spark, " abcd ", lambda c: text.truncate_middle(c, 4)) == "abcd"
    assert one(spark, "a1b२c", text.digits) == "1२"
    assert one(spark, None, lambda c: text.snippet(c, 3)) == ""


def test_numeric(spark):
    df = spark.createDataFrame([("x", "0.5", 3, 0)], "a string, b string, c int, d int")
    row = df.select(
        numeric.first_float(F.col("a"), F.col("b")).alias("f"),
        numeric.safe_ratio(F.col("c"), F.col("d")).alias("r"),
        numeric.safe_int(F.col("a")).alias("i"),
        numeric.clamp01(F.col("c").cast("double")).alias("k"),
        numeric.round4(F.lit(0.12345)).alias("n"),
    ).first()
    assert tuple(row) == (0.5, 0.0, None, 1.0, 0.1235)


def test_json(spark):
    fenced = '```json\n{"a": 1}\n```'
    assert one(spark, fenced, jsontext.extract_json) == '{"a": 1}'
    assert one(spark, 'so {"a": {"b": 2}} ok', jsontext.extract_json) == '{"a": {"b": 2}}'
    assert one(spark, "{broken", jsontext.extract_json) is None
    assert one(spark, None, jsontext.extract_json) is None


def test_nfkc_check_skips_ascii_and_keeps_every_changing_character(spark):
    import unicodedata

    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF and (i < 0x3400 or unicodedata.normalize("NFKC", chr(i)) != chr(i))]
    df = spark.createDataFrame([(f"plain {c}x",) for c in chars], "t string")
    got = df.select("t", text.nfkc(F.col("t")).alias("n"), text.may_change_under_nfkc(F.col("t")).alias("may")).collect()
    assert all(r["n"] == unicodedata.normalize("NFKC", r["t"]) for r in got)
    assert not any(r["may"] for r in got if r["t"].isascii())
