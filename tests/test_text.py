"""Hand-computed cases for the scalar text rules."""

import re

from conftest import one_col
from pyspark.sql import functions as F

from rubric.functions import text as T


def test_first_word_or_line(spark):
    cases = {
        "The answer is Paris": "The",           # four words, no colon: first word
        "Answer: B.": "B",
        "answer:   (c)": "c",
        "Final answer: Paris!": "Paris",
        "Paris": "Paris",
        "New York City!!": "New York City",
        "  B  \nbecause it is": "B",
        "Note: this is long text": "Note",        # prefix is not answer-like
        "الإجابة: ب": "ب",
        "": "",
        None: "",
        "x, y, z, w": "x",
    }
    got = one_col(spark, list(cases), T.first_word_or_line)
    assert got == list(cases.values())


def test_normalize_answer(spark):
    cases = {
        "  Hello,   World! ": "hello world",
        "A)": "a",
        "snake_case-word": "snake_case word",
        "Ça   va?": "ça va",
        "كِتَاب": "ك ت اب",   # Arabic marks are not word characters: replaced by spaces
        "": "",
        None: "",
    }
    assert one_col(spark, list(cases), T.normalize_answer) == list(cases.values())


def test_space_punctuation(spark):
    got = one_col(spark, ["a,b", "x\\ny", "$5=5", "{a}", "a×b"], lambda c: T.space_punctuation(c))
    assert got == ["a , b", "x\\ny", "$5=5", " { a } ", "a × b"]
    braces = one_col(spark, ["{a}"], lambda c: T.space_punctuation(c, change_braces=True))
    assert braces == [" [ a ] "]
    diac = one_col(spark, ["كَتَبَ"], lambda c: T.space_punctuation(c, remove_diacritics=True))
    assert diac == ["كتب"]


def test_extract_asr_text(spark):
    cases = {
        '{"text": "hello there"}': "hello there",
        '{"lang": "en", "transcript": "hi"}': "en",
        '{"text": 0}': "",
        '{"text": 12}': "12",
        '"quoted json"': "quoted json",
        "'single'": "single",
        "  plain words  ": "plain words",
        "42": "42",
    }
    assert one_col(spark, list(cases), T.extract_asr_text) == list(cases.values())


def test_normalize_mcq_answer(spark):
    df = spark.createDataFrame(
        [("B", ["x", "y", "z"]), ("c) zed", ["x", "y", "z"]), (" y ", ["x", "y", "z"]),
         ("Q", ["x", "y"]), (None, ["x"]), ("B", None), ("b", ["x", "y"])],
        "a string, mcq array<string>")
    got = [r[0] for r in df.select(T.normalize_mcq_answer("a", "mcq")).collect()]
    assert got == ["y", "z", "y", "Q", "", "B", "y"]


def test_simple_tokens(spark):
    got = one_col(spark, ['Hello, world! (a) [b] {c} "d"'], lambda c: F.size(T.simple_tokens(c)))
    assert got == [6]


def test_media_suffix(spark):
    names = ["a.png", "dir/B.JPEG", ".png", "..png", "x.png/", "song.MP3", "a.pngx", "doc.txt", "a.wav\n"]
    assert one_col(spark, names, T.is_image) == [True, True, False, True, True, False, False, False, False]
    assert one_col(spark, names, T.is_audio) == [False, False, False, False, False, True, False, False, False]


def test_error_payload(spark):
    msgs = ['API request failed with error message: {"error": {"code": "rate", "n": 1}} tail',
            "plain failure", 'API request failed with error message: {"detail": 1}']
    got = one_col(spark, msgs, T.error_payload)
    assert got[0] == '{"error": {"code": "rate", "n": 1}}'
    assert '"code":"unknown"' in got[1] and '"message":"plain failure"' in got[1] and '"param":null' in got[1]
    assert '"code":"unknown"' in got[2]


def test_small_rules(spark):
    assert one_col(spark, ["  My Task-Name "], T.sanitize_text) == ["my_task_name"]
    assert one_col(spark, ["a<b>c:d"], T.safe_name) == ["a_b_c_d"]
    assert one_col(spark, ["a\nb"], T.escape_newlines) == ["a\\nb"]
    assert one_col(spark, [" Some Key/x.y "], T.key_basic) == ["some_key_x_y"]
    assert one_col(spark, ["uSER"], T.capitalize) == ["User"]


def test_answer_rules_compute_line_and_json_once():
    line, parsed = str(T.first_word_or_line("x")), str(T.extract_asr_text("x"))
    assert line.count("substring_index") == 1
    assert parsed.count("coalesce(x, ") == 1 and len(re.findall(r"try_parse_json\(x_\d+\)", parsed)) == 1
