from __future__ import annotations

import re

import pytest

from tripspark.llm import secret_scan as op

# The base kinds once more, literally.
CI = re.compile("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
                "[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def brute(text):
    out = [("assign", *m.span()) for m in CI.finditer(text) if len(m.group(2)) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out, key=lambda s: (s[1], op.KINDS.index(s[0])))


TEXTS = [
    "", "password=abc12", "password=abc123", "PassWord\"  :  'abc.def/", "secret=token:abcdefgh", "secret=tok token=abcdefg",
    "api_key=apikey = zzzzzz", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 14, "x" + "f" * 23, "g" + "0a" * 12 + "g",
    "token = " + "0123456789abcdef" * 2, "ſecret=abcdefgh toKen=abcdefgh", "é" * 50 + "token=éabcdef passwd='abcdef'",
    "tokentokentoken:=:abcdef", "secret = \n abcdef", "AKIA" * 10, "a" * 100_000 + " password: hunter22 " + "b" * 30,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert [s[:3] for s in op.scan(text) if s[0] != "literal"] == brute(text)


def test_base_spans_of_the_table(spark):
    sf_docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sf_docs.select("doc_id", "text").collect()
    want = {r["doc_id"]: brute(r["text"] or "") for r in rows}
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] != "literal"]
           for r in op.find_secrets(sf_docs).collect()}
    assert got == want and any(want.values())


def literals(text):
    return [text[s:e] for k, s, e, _ in op.scan(text) if k == "literal"]


KEY = "q8Zr-T4vWx!9Lm2#Kp7"
STRONG = "aB3$xY7!mN5%pQ9&rS2*"


def test_names_make_literals_sensitive():
    assert literals(f'DB_PWD = "{KEY}"') == [KEY]
    assert literals(f'color = "{KEY}"') == []
    assert literals(f'"privateKey": "{KEY}",') == [KEY]
    assert literals(f"export AWS_ACCESS_KEY='{KEY}'") == [KEY]
    assert literals('db_pwd = "changeme"\nprivate_key = "your-key-here-1"') == []
    assert literals('auth_pwd = "the quick brown fox"') == []


def test_constants_are_propagated():
    text = f'BASE = "{KEY}"\nOTHER = "{KEY[::-1]}"\nconn = BASE\nclient.credentials = conn\n'
    assert literals(text) == [KEY]
    joined = 'A = "Zq81-Lmx9"\nauth_credential = A + "Wv73!Tpo2"\n'
    assert literals(joined) == ["Zq81-Lmx9", "Wv73!Tpo2"]


@pytest.mark.parametrize("word", sorted(op.SENSITIVE))
def test_every_sensitive_word_is_lexed_in_a_text_of_its_own(word):
    for name in (word, word.upper(), f"{word[:2]}_{word[2:]}", f"{word[:2].title()}{word[2:].title()}"):
        assert op.name_score(name) >= op.SENSITIVE[word] and op.may_be_sensitive(f'{name} = "x"')
        if op.SENSITIVE[word] * op.literal_score(STRONG) >= op.LITERAL_SCORE:
            assert [s[0] for s in op.scan(f'{name} := "{STRONG}"')] in (["literal"], ["assign"])


def test_two_weak_words_are_lexed_in_a_text_of_their_own():
    assert literals(f'signing = "{STRONG}"') == literals(f'connection_access: "{STRONG}"') == [STRONG]


def strong(n):
    return [f"{KEY}{i}" for i in range(n)]


@pytest.mark.parametrize("shape", ["[{}]", "({})", "{{{}}}", "set([{}])", "[[{}], []]", "make({})", "[\n{},\n]"])
@pytest.mark.parametrize("comma", [", ", ",\n  ", ", # note\n"])
def test_all_literals_of_a_bracket_belong_to_its_name(shape, comma):
    text = 'color = "none"\ndb_pwds.pwd = ' + shape.format(comma.join(f'"{k}"' for k in strong(5))) + f'\nname = "{KEY}z"\n'
    assert literals(text) == strong(5)


def test_keys_inside_brackets():
    a, b, c, d = strong(4)
    assert literals(f'{{"color": "{a}", "pwd": "{b}", "name": "{c}"}}') == [b]
    assert literals(f'x = connect(user="{a}", pwd="{b}")\ny = "{c}"') == [b]
    assert literals(f'credentials = {{"db": "{a}", "api": ["{b}", "{c}"]}}\ncolor = "{d}"') == [a, b, c]
    assert literals(f'conf["pwd"] = "{a}"\nconf["color"] = "{b}"') == [a]
    assert literals(f'note :( (\npwd = "{a}"\ncolor = "{b}"\n"{c}"') == [a]


def test_names_built_up_over_many_lines_keep_all_literals():
    keys = strong(300)
    lines = "S = ''\n" + "".join(f'S = S + "{k}"\n' for k in keys) + "pwd = S\nS = 'x'\n"
    assert literals(lines) == keys
    assert literals("S = " + " + ".join(f'"{k}"' for k in keys) + "\ndb_pwd = S") == keys


def test_brackets_take_linear_time():
    for t in ("key=" + "[" * 100_000 + "]" * 100_000, "key=" + "([" * 50_000 + ")" * 50_000, "key=(" + "a=1," * 50_000 + ")",
              "pwd = {" + "a = {" * 20_000 + "}" * 20_001):
        op.scan(t)


def test_prose_is_left_alone():
    assert op.scan("The key: a token of thanks. Passing the secret garden: it was private, access = free.") == []


def test_cases(docs, empty_docs, spark):
    assert op.find_secrets(docs).count() == docs.count()
    assert op.find_secrets(empty_docs).count() == 0
    df = spark.createDataFrame([(1, None), (1, "token=abcdefg"), (1, "token=abcdefg")], "doc_id long, text string")
    assert sorted(len(r["spans"]) for r in op.find_secrets(df).collect()) == [0, 1, 1]


def test_long_inputs_take_linear_time():
    for t in ('"' * 200_000, "a=" * 100_000, "key=" + "a+" * 100_000, "x." * 100_000 + "=pwd", "\\" * 100_000 + "=key"):
        op.scan(t)


def test_many_base_spans_and_literals_take_linear_time():
    """Literals are told from the base spans that hold them as by trying all; 20,000 of either take seconds."""
    import time

    def text(n):
        return "\n".join(f'password = "Zx9{i:06d}qW7"\nsigning_key_{i} = "aB3$xY9!{i:06d}kLmN"\nx = "{i:024x}"' for i in range(n))

    small, base = text(60), []
    found = op.scan(small)
    base = [(s, e) for k, s, e, _ in found if k != "literal"]
    want = [(s, e) for s, e, _ in op.literal_spans(small) if not any(b <= s and e <= f for b, f in base)]
    assert [(s, e) for k, s, e, _ in found if k == "literal"] == want and len(base) > 100 and len(want) >= 60
    begin = time.process_time()
    assert len(op.scan(text(20_000))) > 40_000
    assert time.process_time() - begin < 60
