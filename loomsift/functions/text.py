"""Text functions as column expressions, all native; those that need steps take and give a DataFrame.

White space, lengths and case follow the rules of the feeds these texts come from: white space includes no-break and
ideographic spaces, lengths of tokens count UTF-16 units, all other lengths code points.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes.
SPACE = "\\s\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff"
#: The members of SPACE one by one.
SPACES = " \t\n\x0b\f\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
CJK = "\\u3400-\\u4dbf\\u4e00-\\u9fff"
TERMINATORS = "。！？.!?"
# Lengths in code points that rendered posts keep to, by language.
HOOK_MAX, HOOK_MIN = {"zh": 70, "en": 95}, 12
SUMMARY_MAX, SUMMARY_MIN = {"zh": 300, "en": 450}, {"zh": 200, "en": 300}
BODY_MIN, WHY_MAX = {"zh": 600, "en": 900}, 40
TITLE_ECHO = 0.8


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once for each row, however often later steps use them.

    They are exploded out of an array of one: the optimizer folds a plain column into every place that uses it. Such columns are
    interpreted, and what one holds several times is computed as often: let bound() hold it.
    """
    made = F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("_once")
    return df.select("*", made).select(*[F.col(f"`{c}`") for c in df.columns], "_once.*")


def sub(text: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(text, pattern, by)


def collapse(text: Column) -> Column:
    """Runs of white space become one space; none at the ends. Single spaces, most of the runs, are left as they are."""
    return F.trim(sub(text, f"(?![!-~])(?:[{SPACE}&&[^ ]][{SPACE}]*| [{SPACE}]+)", " "))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def by_lang(lang: Column, limits: dict[str, int]) -> Column:
    return F.when(lang == "zh", limits["zh"]).otherwise(limits["en"])


def normalize(text: Column) -> Column:
    """Lower case, without links, everything but letters and digits made single spaces. Links are sought where one can be."""
    unlinked = F.when(F.contains(text, F.lit("://")), sub(F.lower(text), f"https?://[^{SPACE}]+", " ")).otherwise(F.lower(text))
    return F.trim(sub(unlinked, "[^\\p{L}\\p{N}]+", " "))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), the value computed once however often f looks at it: it is the element of an array of one."""
    return F.get(F.transform(F.array(value), f), 0)


def tokens(text: Column) -> Column:
    """Distinct words of more than one UTF-16 unit, and pairs of neighbouring ideographs."""
    return bound(normalize(text), _tokens_of)


def _tokens_of(norm: Column) -> Column:
    words = F.filter(F.split(norm, " "), lambda w: (F.length(w) > 1) | w.rlike("[\\x{10000}-\\x{10FFFF}]"))
    runs = F.regexp_extract_all(norm, F.lit(f"[{CJK}]{{2,}}"), F.lit(0))
    pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda k: F.substr(r, k, F.lit(2)))))
    return F.array_distinct(F.concat(words, pairs))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays without repeats; 0 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def content_hash(title: Column, body: Column) -> Column:
    return F.sha1(normalize(F.concat(title, F.lit(" "), body)))


def item_id(canonical: Column, title: Column, body: Column) -> Column:
    of_url = F.concat(F.lit("u-"), F.substring(F.sha1(canonical), 1, 20))
    return F.when(canonical != "", of_url).otherwise(F.concat(F.lit("c-"), F.substring(content_hash(title, body), 1, 20)))


def strip_outlet(title: Column) -> Column:
    """Without ' - Outlet Name' (up to four capitalised words) at the end. Printable ASCII, most of a text, begins no match and is
    passed over before the long class of white space is looked at."""
    word = "[A-Z][A-Za-z0-9.'’&]*"
    return strip(sub(title, f"(?![!-~])[{SPACE}]+[-–—|][{SPACE}]+{word}(?:[{SPACE}]+{word}){{0,3}}[{SPACE}]*\\z", ""))


def haystack(text: Column) -> Column:
    return F.concat(F.lit(" "), normalize(text), F.lit(" "))


def matches(hay: Column, keyword: Column) -> Column:
    """A normalised keyword in a haystack: as a whole phrase, or anywhere if it holds an ideograph."""
    return (keyword != "") & F.contains(hay, needle(keyword))


def needle(keyword: Column) -> Column:
    """What a haystack holds if it matches the normalised keyword. Constant for a constant keyword: made once, not for each row."""
    return F.when(keyword.rlike(f"[{CJK}]"), keyword).otherwise(F.concat(F.lit(" "), keyword, F.lit(" ")))


def capitalized(text: Column) -> Column:
    """Words that begin with a capital, lower-cased: with marks taken out, and their parts between marks."""
    found = F.transform(F.regexp_extract_all(text, F.lit("[A-Z][A-Za-z0-9'’-]*"), F.lit(0)), lambda w: F.lower(w))
    parts = F.flatten(F.transform(found, lambda w: F.split(w, "[^a-z0-9]+")))
    return F.array_distinct(F.filter(F.concat(F.transform(found, lambda w: sub(w, "[^a-z0-9]", "")), parts), lambda w: F.length(w) >= 3))


def _is_cjk(token: Column) -> Column:
    return token.rlike(f"[{CJK}]")


def _long_tokens(found: Column, stop: Column) -> Column:
    return F.filter(found, lambda t: ((F.length(t) >= 3) | ((F.length(t) == 2) & _is_cjk(t))) & ~F.array_contains(stop, t))


def _latin_runs(long: Column, stop: Column) -> Column:
    # A token of nothing else is its own run, and there already.
    runs = F.flatten(F.transform(F.filter(long, lambda t: t.rlike("[^a-z0-9]")), lambda t: F.regexp_extract_all(t, F.lit("[a-z0-9]{3,}"), F.lit(0))))
    return F.filter(runs, lambda r: ~F.array_contains(stop, r))


def _stop(stopwords: list[str]) -> Column:
    return F.array(*map(F.lit, stopwords)) if stopwords else F.array().cast("array<string>")


def topic_tokens(text: Column, stopwords: list[str]) -> Column:
    """Tokens long enough and no stop words, and the Latin runs inside them.

    The long tokens are bound: they are looked at several times, but made once.
    """
    stop = _stop(stopwords)
    return bound(_long_tokens(tokens(text), stop), lambda long: F.array_distinct(F.concat(long, _latin_runs(long, stop))))


def with_proper_tokens(df: DataFrame, text: Column, out: str, stopwords: list[str]) -> DataFrame:
    """df with `out`: the topic tokens that begin with a capital in the text, or are ideographs.

    Each step is a column: a lambda that looks something up for every token must not compute it for every token.
    """
    stop = _stop(stopwords)
    staged = df.withColumn("_cap", capitalized(text)).withColumn("_tok", tokens(text))
    staged = staged.withColumn("_long", _long_tokens(F.col("_tok"), stop)).withColumn("_runs", _latin_runs(F.col("_long"), stop))
    kept = F.filter("_long", lambda t: _is_cjk(t) | F.array_contains(F.col("_cap"), t))
    runs = F.filter("_runs", lambda r: F.array_contains(F.col("_cap"), r))
    return staged.withColumn(out, F.array_distinct(F.concat(kept, runs))).drop("_cap", "_tok", "_long", "_runs")


def with_entities(df: DataFrame, title: str, out: str, stopwords: list[str]) -> DataFrame:
    """df with `out`: proper-noun tokens of the title without its outlet; of the whole title if there are none."""
    staged = with_proper_tokens(df.withColumn("_bare", strip_outlet(F.col(title))), F.col("_bare"), "_first", stopwords)
    again = (F.size("_first") == 0) & (F.col("_bare") != F.col(title))
    staged = staged.withColumn("_whole", F.when(again, F.col(title)).otherwise(F.lit("")))
    staged = with_proper_tokens(staged, F.col("_whole"), "_second", stopwords)
    return staged.withColumn(out, F.when(again, F.col("_second")).otherwise(F.col("_first"))).drop("_bare", "_first", "_whole", "_second")


def detect_lang(text: Column) -> Column:
    share = lambda head: F.length(sub(head, f"[^{CJK}]+", "")) / F.length(head)
    return bound(F.substring(text, 1, 400), lambda head: F.when((F.length(head) > 0) & (share(head) > 0.3), F.lit("zh")).otherwise(F.lit("en")))


def truncate(text: Column, most: Column | int) -> Column:
    """At most so many code points, the last an ellipsis if cut."""
    most = F.lit(most) if isinstance(most, int) else most
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substr(text, F.lit(1), most - 1), F.lit("…")))


def first_sentence(text: Column, most: Column | int) -> Column:
    return sentence_of(collapse(text), most)


def sentence_of(clean: Column, most: Column | int) -> Column:
    """The first sentence of a text whose white space is collapsed. What is cut off at `most` need not be looked at: two code points
    more, of which one may be a space, tell that something is."""
    head = F.substr(clean, F.lit(1), (F.lit(most) if isinstance(most, int) else most) + 2)
    found = F.regexp_extract(head, f"^[^{TERMINATORS}]*[{TERMINATORS}]", 0)
    return truncate(F.trim(F.when(found != "", found).otherwise(head)), most)


def split_sentences(text: Column) -> Column:
    """Sentences of HOOK_MIN code points at least."""
    return _sentences(_parts(text))


def _parts(text: Column) -> Column:
    return F.split(text, f"(?<=[。！？])[{SPACE}]*|(?<=[.!?])[{SPACE}]+")


def _sentences(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda s: F.length(s) >= HOOK_MIN)


def where_shows(text: Column, signs: list[str], f: Callable[[Column], Column]) -> Column:
    """f(text) for texts that hold one of the signs (lower case; any case counts), all others as they are: what f looks for has
    one of them, and looking for a sign is far cheaper than for a pattern. Texts without a mark that all signs have, and signs
    without letters, need no lower case."""
    one_of = lambda t: any_of([F.contains(t, F.lit(s)) for s in signs])
    marks = [m for m in signs[0] if m in "<&:" and all(m in s for s in signs)]
    in_any_case = lambda t: bound(F.lower(t), one_of)
    if all(s in "<&:" for s in signs):
        shows = one_of
    elif marks:
        shows = lambda t: F.contains(t, F.lit(marks[0])) & in_any_case(t)
    else:
        shows = in_any_case
    return bound(text, lambda t: F.when(shows(t), f(t)).otherwise(t))


METADATA_SIGNS = ["arxiv:", "announce type:", "abstract:"]


def strip_metadata(text: Column) -> Column:
    return collapse(where_shows(text, METADATA_SIGNS, _bare_of_metadata))


def strip_both(text: Column) -> Column:
    """strip_metadata(strip_html(text)): what has no metadata is not collapsed a second time."""
    return where_shows(strip_html(text), METADATA_SIGNS, lambda t: collapse(_bare_of_metadata(t)))


def _bare_of_metadata(text: Column) -> Column:
    out = sub(text, f"(?i)^[{SPACE}]*arxiv:[^{SPACE}]+[{SPACE}]*", " ")
    out = sub(out, f"(?i)(?<![A-Za-z0-9_])Announce Type:[{SPACE}]*[^{SPACE}]+", " ")
    return sub(out, f"(?i)^[{SPACE}]*Abstract:[{SPACE}]*", " ")


def strip_html(text: Column) -> Column:
    """Without style and script elements and tags; the commonest character references decoded, then tags again."""
    untagged = lambda t: sub(t, "<[^>]+>", " ")
    out = where_shows(text, ["<"], lambda t: untagged(sub(sub(t, "(?i)<style[\\s\\S]*?</style>", " "), "(?i)<script[\\s\\S]*?</script>", " ")))
    return collapse(where_shows(where_shows(out, ["&"], _decoded), ["<"], untagged))


def _decoded(text: Column) -> Column:
    for reference, by in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#039;", "'"), ("&apos;", "'"), ("&nbsp;", " ")):
        text = F.replace(text, F.lit(reference), F.lit(by))
    return text


def truncate_why(text: Column, most: int) -> Column:
    """Cut at a word if at least half of the room stays filled, else in a word."""
    marks = f"[{SPACE}，。、！？·,:;!?–—\"'()（）]+\\z"
    head = F.substring(text, 1, most - 1)

    def cut(bare: Column) -> Column:
        last = F.length(bare) - F.locate(" ", F.reverse(bare))  # the place of the last space
        has = F.contains(bare, F.lit(" ")) & (last >= most // 2)
        at_word = sub(F.substr(bare, F.lit(1), last), marks, "")
        return F.when(has, at_word).when(F.length(bare) >= most // 2, bare).otherwise(head)

    return F.when(F.length(text) <= most, text).otherwise(F.concat(bound(sub(head, marks, ""), cut), F.lit("…")))


def ensure_summary_floor(summary: Column, body: Column, lang: Column) -> Column:
    """Sentences of the body that the summary lacks are added until it is long enough."""
    most, least = by_lang(lang, SUMMARY_MAX), by_lang(lang, SUMMARY_MIN)
    return bound(truncate(strip(summary), most), lambda capped: F.when(F.length(capped) >= least, capped).otherwise(truncate(_longer(capped, body, least), most)))


#: Code points of a body that are looked at first, where its head may do.
HEAD = 1200


def _longer(capped: Column, body: Column, least: Column) -> Column:
    """The parts that are whole in the head of a body are those of the body: if they are enough, the rest is not split."""
    head = bound(_parts(strip_metadata(F.substring(body, 1, HEAD))), lambda parts: F.slice(parts, 1, F.size(parts) - 1))
    whole = lambda: _added(capped, split_sentences(strip_metadata(body)), least)["parts"]
    told = bound(_added(capped, _sentences(head), least), lambda state: F.when(state["n"] >= least, state["parts"]).otherwise(whole()))
    return F.array_join(told, " ")


def _added(capped: Column, sentences: Column, least: Column) -> Column:
    start = F.struct(F.array(capped).alias("parts"), F.length(capped).alias("n"))

    def add(state: Column, sentence: Column) -> Column:
        seen = F.exists(state["parts"], lambda p: F.contains(p, sentence))
        more = F.struct(F.array_append(state["parts"], sentence).alias("parts"), (state["n"] + F.length(sentence) + 1).alias("n"))
        return F.when((state["n"] >= least) | seen, state).otherwise(more)

    return F.aggregate(sentences, start, add)


def _bare(hook: Column) -> Column:
    return strip(sub(hook, "…\\z", ""))


def is_title_prefix(hook: Column, title: Column) -> Column:
    return bound(_bare(hook), lambda bare: (bare != "") & F.startswith(title, bare) & (F.length(bare) >= F.length(title) * 0.6))


def title_overlap(hook: Column, title: Column) -> Column:
    """Share of the hook's tokens that the title has."""
    own = tokens(_bare(hook))
    return F.when(F.size(own) > 0, F.size(F.array_intersect(own, tokens(title))) / F.size(own)).otherwise(F.lit(0.0))


def derive_hooks(title: Column, title_tokens: Column, sentences: Column, entities: Column, domain: Column, lang: Column) -> Column:
    """Up to three distinct hooks: lead sentence, entity card, second sentence, domain card, entity with lead.

    Sentences that echo the title come last, and a lead that does is left out of the first places. The arrays are best
    columns of their own, as each is used many times: the title's tokens, the sentences of the text, its entities.
    """
    most, none = by_lang(lang, HOOK_MAX), F.lit("")
    top = F.slice(entities, 1, 3)
    card = F.array_join(top, " · ")
    lead, second = (truncate(F.coalesce(F.get(sentences, k), none), most) for k in (0, 1))
    domain_card = F.when(card != "", truncate(F.concat(domain, F.lit("｜"), card), most)).otherwise(none)
    entity_lead = F.coalesce(truncate(F.concat(F.get(top, 0), F.lit("："), F.get(sentences, 0)), most), none)
    own = [(lead, True), (truncate(card, most), False), (second, True), (domain_card, False), (entity_lead, True)]
    made = F.array(*[F.struct(strip(t).alias("text"), F.lit(s).alias("sentence")) for t, s in own])

    def echo(text: Column) -> Column:
        return bound(tokens(_bare(text)), lambda found: (F.size(found) > 0) & (F.size(F.array_intersect(found, title_tokens)) / F.size(found) >= TITLE_ECHO))

    told = F.transform(made, lambda c: F.struct(c["text"].alias("text"), (c["sentence"] & echo(c["text"])).alias("echo")))

    def chosen(cards: Column) -> Column:
        lead_echoes = F.get(cards, 0)["echo"] & (F.get(cards, 0)["text"] != "")
        # A lead that echoes the title goes, and the second sentence comes before the card.
        order = F.when(lead_echoes, F.array(F.get(cards, 2), F.get(cards, 1), F.get(cards, 3), F.get(cards, 4))).otherwise(cards)
        fit = F.filter(order, lambda c: (F.length(c["text"]) >= HOOK_MIN) & ~is_title_prefix(c["text"], title))
        both = bound(fit, lambda cards: F.concat(F.filter(cards, lambda c: ~c["echo"]), cards))
        return F.slice(F.array_distinct(F.transform(both, lambda c: c["text"])), 1, 3)

    # The cards are bound once, as the element of an array of one.
    return F.get(F.transform(F.array(told), chosen), 0)


def stale_year(title: Column, year: Column) -> Column:
    """The first year written out as a date in the title that lies before last year, else null."""
    month = "(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
    edge, after = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
    dates = F.regexp_extract_all(title, F.lit(f"(?i)(?:19|20)\\d{{2}}[{SPACE}]*年|{month}[a-z]*\\.?[{SPACE}]+(?:19|20)\\d{{2}}|{edge}(?:19|20)\\d{{2}}-\\d{{2}}{after}"), F.lit(0))
    years = F.transform(dates, lambda d: F.regexp_extract(d, "(?:19|20)\\d{2}", 0).cast("int"))
    return F.get(F.filter(years, lambda y: y < year - 1), 0)


def keyword_hits(hay: Column, keywords: list[str]) -> Column:
    """The keywords that the haystack matches, in their order."""
    if not keywords:
        return F.array().cast("array<string>")
    words = F.array(*[F.struct(F.lit(k).alias("word"), normalize(F.lit(k)).alias("norm"), needle(normalize(F.lit(k))).alias("needle")) for k in keywords])
    return F.transform(F.filter(words, lambda k: (k["norm"] != "") & F.contains(hay, k["needle"])), lambda k: k["word"])


def head_of(text: Column) -> Column:
    """The first HEAD code points of a text, to the last white space in them: no word is cut. Shorter texts whole."""
    return F.when(F.length(text) <= HEAD, text).otherwise(F.regexp_extract(F.substring(text, 1, HEAD), f"(?s)^.*[{SPACE}]", 0))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def substance(text: Column) -> Column:
    """Words of two Latin letters at least and ideographs, without links and the counters of viewers."""
    counters = "(?i)(?=[\\d,.sw])(?:[\\d,.]+\\s*[KMB]?\\s*(?:views|subscribers|plays)|watch\\s+later|subscribe\\b|share\\b)"
    bare = sub(sub(text, f"https?://[^{SPACE}]+", " "), counters, " ")
    count = lambda p: F.size(F.regexp_extract_all(bare, F.lit(p), F.lit(0)))
    return count("[A-Za-z]{2,}") + count("[\\u4e00-\\u9fff]")


def digest_id(raw: Column) -> Column:
    """Lower-case Latin letters and digits only; 'x' if none are left."""
    kept = sub(F.lower(raw), "[^a-z0-9]", "")
    return F.when(kept != "", kept).otherwise(F.lit("x"))
