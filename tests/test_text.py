import pytest
from pyspark.sql import functions as F

from labelnet.functions import porter
from labelnet.functions import text as tx
from labelnet.plans import sqlparts


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("html,expected", [
    ("a<p>b", "ab"),                                         # joined with no separator
    ('<script>var t="</p>";</script>x', "x"),                # script body holding a closing tag
    ("<!-- c <b> -->y", "y"),                                 # comment
    ("&amp;copy;", "&copy;"),                                 # &amp; decoded last, once
    ("<style>p{margin:0}</style>z &quot;q&quot;", 'z "q"'),
    (None, None),
    ("it&#8217;s caf&eacute; a < b and c > d", "it\u2019s caf\u00e9 a < b and c > d"),
    ("&#x27;x&#39; &nosuch; &amp;copy; &copy; &#1114112;", "'x' &nosuch; &copy; \u00a9 &#1114112;"),
])
def test_html_to_text(spark, html, expected):
    assert one(spark, html, tx.html_to_text) == expected


def test_normalize_and_tokens(spark):
    assert one(spark, "  Don't STOP!  ", tx.normalize_text) == "dont stop"
    assert one(spark, "naïve", tx.normalize_text) == "na ve"         # lower, then non-ASCII -> space
    assert one(spark, "https://x.y z", lambda c: tx.strip_urls(tx.normalize_text(c))) == " z"
    assert one(spark, "!!! ...", lambda c: tx.word_tokens(tx.normalize_text(c))) == []


def test_stopwords_keep_order_and_duplicates(spark):
    got = one(spark, "the cat and the cat is a dog", lambda c: tx.remove_stopwords(tx.word_tokens(c)))
    assert got == ["cat", "cat", "dog"]


def test_clean_text_null_is_empty(spark):
    assert one(spark, None, tx.clean_text) == ""
    assert one(spark, "<p>Hello, World of the Tests</p>", tx.clean_text) == "hello world tests"


# the published splits of the word tokeniser, then marks deleted, URL pieces and stop words removed
@pytest.mark.parametrize("text,words", [
    ("hello,world", ["hello", "world"]), ("foo(bar)", ["foo", "bar"]), ("don't stop", ["nt", "stop"]), ("https://x.y/z", ["xyz"]),
    ("1,000 at 10:30", ["1000", "1030"]), ("it&#8217;s caf&eacute;", ["caf"]), ("rock&#x27;n", ["rockn"]),
    ("a < b and c > d", ["b", "c"]), ("john's we'll cannot gonna.", ["john", "gon", "na"]), ("wait...what -- yes", ["wait", "yes"]),
    ("x;y \"quoted\" e.g. end.", ["x", "quoted", "eg", "end"]), ("well-known 50% C#", ["wellknown", "50", "c"]),
])
def test_word_splits_come_before_marks_go(spark, text, words):
    assert one(spark, text, tx.clean_tokens) == words


def test_fixed_lists():
    assert len(tx.STOP_WORDS) == 179 and len(set(tx.STOP_WORDS)) == 179
    assert len(tx.PUNCTUATION) == 32


# published examples of the 1980 paper (whole algorithm)
PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "digitizer": "digit", "operator": "oper", "feudalism": "feudal",
    "hopefulness": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "defensible": "defens",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "communism": "commun", "activate": "activ", "effective": "effect", "bowdlerize": "bowdler",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "generalizations": "gener", "oscillators": "oscil",
}


def test_porter(spark):
    words = {**PORTER, "at": "at", "y": "y", "": "", "Cats": "cat", "syzygy": "syzygi", "yyyy": "yyyi", "sayyid": "sayyid", "2nds": "2nd", "die": "die", "ing": "ing", "eed": "eed", "controlled": "control", "ion": "ion", "opinion": "opinion", "vision": "vision"}
    df = spark.createDataFrame([(w, 1) for w in words] + [(None, 1)], "term string, n int")
    got = {r.term: r.stem for r in porter.stems(df, "term").collect()}
    assert got == {**words, None: None}
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE words (term VARCHAR)")
    con.executemany("INSERT INTO words VALUES (?)", [[w] for w in words])
    assert dict(con.sql(sqlparts.with_(sqlparts.stem_parts("words", "term", "st"), "SELECT term, stem FROM st")).fetchall()) == words


def test_tokens_match_python_normalisation_on_random_text(spark):
    import random
    import re
    import string as pystring
    rnd = random.Random(17)
    pool = (list(pystring.ascii_letters + pystring.digits + pystring.punctuation) + [" ", " ", "\t", "\n"]
            + ["é", "ß", "İ", "K", "ü", "ñ", " ", "😀", "中"])
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60))) for _ in range(400)]

    def python_tokens(t):
        t = t.strip().lower().translate(str.maketrans("", "", pystring.punctuation))
        t = re.sub(r"[^\x00-\x7f]", " ", t)
        return re.findall(r"[a-z0-9]+", t)

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.w for r in df.select("i", tx.word_tokens(tx.normalize_text("t")).alias("w")).collect()}
    assert all(got[i] == python_tokens(t) for i, t in enumerate(texts))


def test_html_to_text_matches_stdlib_parser_on_pages(spark):
    from html.parser import HTMLParser

    class Text(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.skip = [], 0

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style")

        def handle_endtag(self, tag):
            self.skip -= tag in ("script", "style") and self.skip > 0

        def handle_data(self, data):
            if not self.skip:
                self.out.append(data)

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = pages.select("page_id", "html", tx.html_to_text("html").alias("text")).collect()
    assert rows
    for r in rows:
        p = Text()
        p.feed(r.html)
        p.close()
        assert r.text == "".join(p.out), r.page_id


def test_splits_in_one_pass_give_the_tokens_of_all_rules(spark):
    """``split_words`` leaves blanks out that change no token; here all rules run one after the other."""
    import random
    rnd = random.Random(23)
    pieces = ["a", "b1", "Word", "9", "10", "don't", "cannot", "GIMME", "gonna-x", "d'ye", "more'n", "wanna ", "'tis", " 'twas", "'", "''", "'s", "n't", "'ll",
              ".", "..", "...", ",", ",,", ":", ";", "--", "-", "---", "`", "``", '"', "(", ")", "]", "}", ">", "<", "?", "!", "&", "@", "#", "%", " ", " ", " ",
              "\n", "\t", "é", "x_y", "http", "https://x.y/z", "U.S.", "_cannot", "1,000", "10:30", "e.g."]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]

    def every(x):
        x = F.concat(F.lit(" "), x, F.lit(" "))
        for pattern, to in tx.SPLITS + tx.CONTRACTIONS:
            x = F.regexp_replace(x, F.lit(pattern), F.lit(to.replace("\\", "$")))
        return x
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    tokens = lambda x: tx.word_tokens(tx.strip_urls(tx.normalize_text(x)))
    bad = df.select("t", tokens(tx.split_words("t")).alias("a"), tokens(every(F.col("t"))).alias("b")).where("a <> b").collect()
    assert not bad, bad[:5]
