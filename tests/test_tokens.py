import html.entities
import re

import pytest
from pyspark.sql import functions as F

from oreline.functions import tokens as tk

EXAMPLES = {
    "call +1 (800) 123-4567 now": ["call", "+1 (800) 123-4567", "now"],
    "123 4567": ["123 4567"],
    "see http://T.co/AbC?x=1&y=%2F ok": ["see", "http://T.co/AbC?x=1&y=%2F", "ok"],
    "HTTPS://A.b/C!": ["HTTPS://A.b/C!"],
    ":) :-( D: <3 ;P": [":)", ":-(", "d:", "<", "3", ";p"],
    "a <b class='X'>bold</b>": ["a", "<b class='x'>", "bold", "</b>"],
    "Re @User_1: #BigSale #a ##x-y": ["re", "@user_1", ":", "#bigsale", "#", "a", "##x-y"],
    "it's a well-known don't": ["it's", "a", "well-known", "don't"],
    "3/4 -1.5 10:30 42": ["3/4", "-1.5", "10:30", "42"],
    "wait... . . . end.": ["wait", "... . . .", "end", "."],
    # Compound words are ASCII and come before plain ones, so they cut here.
    "naïve café Été über": ["naïve", "caf", "é", "été", "über"],
    "…“quoted”": ["…", "“", "quoted", "”"],
    "": [],
    "   ": [],
    "&amp; &#39;": ["&", "amp", ";", "&", "#39", ";"],
}


def tokens(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    df = df.withColumn("text", tk.decode_html(F.col("text"))) if options.pop("decode", 0) else df
    out = {i: [] for i in range(len(texts))}
    arrays = df.select("id", tk.raw_tokens(F.col("text")).alias("a"))
    rows = arrays.select("id", F.posexplode("a").alias("p", "t")).select(
        "id", "p", tk.fold_case(F.col("t"), **options).alias("t")).orderBy("id", "p").collect()
    for r in rows:
        out[r["id"]].append(r["t"])
    return list(out.values())


def test_token_classes(spark):
    got = tokens(spark, list(EXAMPLES))
    assert dict(zip(EXAMPLES, got)) == EXAMPLES


def test_same_as_python_regex(spark):
    """The classes written with Python's own \\w, \\d and \\s give the same tokens."""
    space = r"\s"
    pattern = "|".join([
        rf"(?:\+?[01][{space}.-]*)?(?:\(?\d{{3}}[{space}.)-]*)?\d{{3}}[{space}.-]*\d{{4}}",
        r"https?://[!$-_a-z]+", tk.EMOTICON, r"<[^>]+>", r"@\w+", r"#+\w+[\w'-]*\w+",
        r"[a-z][a-z'_-]+[a-z]", r"[+-]?\d+[,/.:-]\d+[+-]?", r"\w+", r"\.(?:\s*\.)+", r"\S"])
    texts = list(EXAMPLES) + [
        "हिन्दी शब्द ٣٤٥ 日本語テキスト １２３４５６７", "x y z\x85w", "a_b_c __ _", "<<>>==8)",
        "caféteria l'été", "http://", "...", "1-800-555-1234-", "éclair",
        "#1 #_a #a'b- @ # @@x"]
    want = [[t if "://" in t and re.search(r"https?://[!$-_a-z]+", t, re.I) else t.lower()
             for t in re.findall(pattern, s, re.I)] for s in texts]
    assert tokens(spark, texts) == want


def test_emoticons_keep_case_on_request(spark):
    assert tokens(spark, [":D Yes X"], keep_case="emoticon") == [[":D", "yes", "x"]]
    assert tokens(spark, [":D Yes X"]) == [[":d", "yes", "x"]]


def test_long_runs_do_not_overflow(spark):
    long = "." * 20000 + " http://" + "a%2F" * 5000 + " " + "x'" * 9000 + "x"
    assert len(tokens(spark, [long])[0]) == 3


def decode_plain(s):
    for ent in set(re.findall(r"&#[0-9]+;", s)):
        n = int(ent[2:-1])
        if n <= 0x10FFFF and not 0xD800 <= n <= 0xDFFF:
            s = s.replace(ent, chr(n))
    for ent in set(re.findall(r"&[A-Za-z0-9_]+;", s)):
        name = ent[1:-1]
        if name != "amp" and name in html.entities.name2codepoint:
            s = s.replace(ent, chr(html.entities.name2codepoint[name]))
    return s.replace("&amp;", " and ")


@pytest.mark.parametrize("text", [
    "a &amp; b", "&#39;x&#x27;&#00065;", "&lt;b&gt; &eacute;&unknown; &;&&", "&#38;lt; &#38;amp;",
    "&#65279;|&#128512;|&#55296;|&#1114112;|&#99999999999;", "plain", "&copy;&copy;&middot;&quot;"])
def test_entities(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(tk.decode_html(F.col("s"))).first()[0] == decode_plain(text)


def test_decoding_changes_the_tokens(spark):
    assert tokens(spark, ["you &amp; me"], ) == [["you", "&", "amp", ";", "me"]]
    assert tokens(spark, ["you &amp; me"], decode=1) == [["you", "and", "me"]]
