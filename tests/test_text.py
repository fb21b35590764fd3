"""Text functions against plain-Python twins, on random strings and on known cases."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from loomsift.functions import text as T
from loomsift.functions import urls as U

SPACE = " \t\n 　"
ALPHABET = list("abcXYZ019 .,!?-–|'&") + list(SPACE) + ["é", "É", "ñ", "日", "本", "語", "。", "！", "😀", "https://x.y/z", "Abstract:", "arXiv:1 ", "…", "<b>", "&amp;", "The", " - Big News"]


def random_texts(n=300, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def normalize(s):
    s = re.sub(r"https?://\S+", " ", s.lower())
    return " ".join("".join(c if unicodedata.category(c)[0] in "LN" else " " for c in s).split())


def tokens(s):
    words = [w for w in normalize(s).split(" ") if len(w.encode("utf-16-le")) > 2]
    runs = re.findall("[㐀-䶿一-鿿]{2,}", normalize(s))
    return set(words) | {r[k : k + 2] for r in runs for k in range(len(r) - 1)}


def truncate(s, n):
    return s if len(s) <= n else s[: n - 1] + "…"


def first_sentence(s, n):
    clean = " ".join(s.split())
    m = re.match("[^。！？.!?]*[。！？.!?]", clean)
    return truncate((m[0] if m else clean).strip(), n)


def sentences(s):
    parts = re.split(r"(?<=[。！？])\s*|(?<=[.!?])\s+", s)
    return [p.strip() for p in parts if len(p.strip()) >= 12]


def lang(s):
    head = s[:400]
    return "zh" if head and sum("㐀" <= c <= "䶿" or "一" <= c <= "鿿" for c in head) / len(head) > 0.3 else "en"


def truncate_why(s, n):
    if len(s) <= n:
        return s
    head = s[: n - 1]
    marks = r"[\s，。、！？·,:;!?–—\"'()（）]+$"
    bare = re.sub(marks, "", head)
    at = bare.rfind(" ")
    if at >= n // 2:
        return re.sub(marks, "", bare[:at]) + "…"
    return (bare if len(bare) >= n // 2 else head) + "…"


@pytest.mark.parametrize(
    "column, twin",
    [
        (lambda: T.normalize(F.col("t")), normalize),
        (lambda: F.sort_array(T.tokens(F.col("t"))), lambda s: sorted(tokens(s), key=lambda x: x.encode())),
        (lambda: T.truncate(F.col("t"), 10), lambda s: truncate(s, 10)),
        (lambda: T.first_sentence(F.col("t"), 20), lambda s: first_sentence(s, 20)),
        (lambda: T.split_sentences(F.col("t")), sentences),
        (lambda: T.detect_lang(F.col("t")), lang),
        (lambda: T.truncate_why(F.col("t"), 20), lambda s: truncate_why(s, 20)),
    ],
    ids=["normalize", "tokens", "truncate", "first_sentence", "sentences", "lang", "why"],
)
def test_against_twins(spark, column, twin):
    texts = random_texts()
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", column().alias("v")).collect()
    for r in rows:
        assert r.v == twin(texts[r.k]), repr(texts[r.k])


def one(spark, column, **values):
    columns = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*columns).select(column.alias("v")).first().v


def test_known_cases(spark):
    t = F.col("t")
    assert one(spark, T.strip_outlet(t), t="A new thing - The Daily News") == "A new thing"
    assert one(spark, T.strip_outlet(t), t="A new thing - not an outlet") == "A new thing - not an outlet"
    assert one(spark, T.strip_html(t), t="<p>a &lt;b&gt;x<script>1</script> &amp; &#39;y&#39;</p>") == "a x & 'y'"
    assert one(spark, T.strip_metadata(t), t="arXiv:2401.1 Announce Type: new Then it works.") == "Then it works."
    for title, word, hit in (("storage", "rag", False), ("upbeat day", "beat", False), ("The RAG way", "rag", True), ("新模型发布", "模型", True), ("open-source now", "open source", True)):
        assert one(spark, T.matches(T.haystack(t), T.normalize(F.lit(word))), t=title) is hit
    assert one(spark, T.stale_year(t, F.lit(2026)), t="Report of Mar 2019 and 2025-01") == 2019
    assert one(spark, T.stale_year(t, F.lit(2026)), t="In 2019 there was") is None
    assert one(spark, T.is_title_prefix(F.col("h"), t), h="A long title…", t="A long title here") is True
    assert one(spark, T.is_title_prefix(F.col("h"), t), h="A long", t="A long title that goes on") is False


def test_digest_ids(spark):
    assert [one(spark, T.digest_id(F.col("t")), t=t) for t in ("Daily-2024/É", "--", "")] == ["daily2024", "x", "x"]


def test_entities_and_hooks(spark):
    titles = spark.createDataFrame([(0, "The Astra model beats GPT-5 - Some Outlet"), (1, "nothing here - Big News"), (2, "新模型 of Acme-Labs"), (3, "")], "k int, t string")
    found = {r.k: set(r.e) for r in T.with_entities(titles, "t", "e", ["the"]).collect()}
    assert found == {0: {"astra", "gpt"}, 1: {"big", "news"}, 2: {"新模型", "新模", "模型", "acme", "labs"}, 3: set()}
    title, summary = "Astra wins the race", "The Astra team reported a win on Monday. A second sentence tells of the race in detail. More."
    hooks = T.derive_hooks(F.col("t"), T.tokens(F.col("t")), T.split_sentences(F.col("s")), T.topic_tokens(F.col("s"), ["the", "of"]), F.lit("sport"), F.lit("en"))
    found = one(spark, hooks, t=title, s=summary)
    assert found[0] == "The Astra team reported a win on Monday." and len(found) == 3 == len(set(found))
    echo = one(spark, hooks, t="The Astra team reported a win on time", s=summary)
    assert echo[0] == "A second sentence tells of the race in detail."


def test_summary_floor(spark):
    body = " ".join(f"This is sentence number {k} of the body, with some words." for k in range(20))
    made = one(spark, T.ensure_summary_floor(F.col("s"), F.col("b"), F.lit("en")), s="Short one.", b=body)
    assert 300 <= len(made) <= 450 and made.startswith("Short one. This is sentence number 0")


@pytest.mark.parametrize(
    "raw, want",
    [
        ("https://www.Example.com:8080/a/b/?utm_source=x&B=2&a=1#top", "https://example.com/a/b?a=1&b=2"),
        ("http://example.com", "http://example.com/"),
        ("http://example.com///", "http://example.com/"),
        ("https://example.com/p?fbclid=1&ref=2", "https://example.com/p"),
        ("https://example.com/p?q=a%20b+c", "https://example.com/p?q=a b c"),
        ("ftp://example.com/x", ""),
        ("not a url", ""),
        ("", ""),
    ],
)
def test_canonical_url(spark, raw, want):
    assert one(spark, U.canonical_url(F.col("u")), u=raw) == want


@pytest.mark.parametrize(
    "url, safe",
    [
        ("https://example.com/x", True), ("http://example.com/x", False), ("https://localhost/x", False), ("https://10.1.2.3/x", False), ("https://172.20.0.1/", False),
        ("https://8.8.8.8/", True), ("https://user@example.com/", False), ("https://[::1]/", False), ("https://[fd00::1]/", False), ("nonsense", False),
    ],
)
def test_public_https(spark, url, safe):
    assert one(spark, U.is_public_https(F.col("u")), u=url) is safe


def test_since_days():
    assert U.since_days("q?d>{{since_days:2}}", 1_704_240_000_000) == "q?d>2024-01-01"


#: Urls as browsers take them, and their canonical forms.
ODD_URLS = (
    ("https://a.example/x?q=a|b", "https://a.example/x?q=a|b"),
    ("https://a.example/a b", "https://a.example/a%20b"),
    ("https://my_host.example/x/", "https://my_host.example/x"),
    ("  HTTP://WWW.A.Example:8080/P//?utm_source=1&b=2&A=1#top", "http://a.example/P?a=1&b=2"),
    ("https://user:pw@a.example", "https://a.example/"),
    ("https://a.example/é?x=%41+b", "https://a.example/%C3%A9?x=A b"),
    ("ftp://a.example/x", ""),
    ("https:///", ""),
    ("not a url", ""),
    ("javascript:alert(1)", ""),
    ("https://a.example?ref=1", "https://a.example/"),
)


@pytest.mark.parametrize("raw, want", ODD_URLS)
def test_urls_as_browsers_take_them(spark, raw, want):
    assert one(spark, U.canonical_url(F.col("u")), u=raw) == want
