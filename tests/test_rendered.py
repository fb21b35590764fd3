"""rendered_posts against a plain reading of how a post is written, over every page and over odd items."""

import pytest
import regex

from loomsift import queries
from loomsift.operators import render
from loomsift.operators.items import from_pages

S = " \t\n\x0b\f\r\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
HAN = "\u3400-\u4dbf\u4e00-\u9fff"
MOST = {"hook": {"zh": 70, "en": 95}, "summary": {"zh": 300, "en": 450}, "least": {"zh": 200, "en": 300}}


def collapse(t):
    return regex.sub(f"[{S}]+", " ", t).strip(" ")


def strip(t):
    return regex.sub(f"^[{S}]+|[{S}]+\\Z", "", t)


def without_tags(t):
    for pattern, by in (("(?is)<style.*?</style>", " "), ("(?is)<script.*?</script>", " "), ("<[^>]+>", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#0?39;|&apos;", "'"), ("&nbsp;", " "), ("<[^>]+>", " ")):
        t = regex.sub(pattern, by, t)
    return collapse(t)


def without_metadata(t):
    t = regex.sub(f"(?i)^[{S}]*arxiv:[^{S}]+[{S}]*", " ", t)
    t = regex.sub(f"(?i)(?<![A-Za-z0-9_])Announce Type:[{S}]*[^{S}]+", " ", t)
    return collapse(regex.sub(f"(?i)^[{S}]*Abstract:[{S}]*", " ", t))


def cut(t, most):
    return t if len(t) <= most else t[: most - 1] + "…"


def language(t):
    head = t[:400]
    return "zh" if head and len(regex.findall(f"[{HAN}]", head)) / len(head) > 0.3 else "en"


def first_sentence(t, most):
    t = collapse(t)
    found = regex.match("[^。！？.!?]*[。！？.!?]", t)
    return cut((found[0] if found else t).strip(" "), most)


def sentences(t):
    return [s for s in map(strip, regex.split(f"(?<=[。！？])[{S}]*|(?<=[.!?])[{S}]+", t)) if len(s) >= 12]


def norm(t):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", regex.sub(f"https?://[^{S}]+", " ", t.lower())).strip(" ")


def tokens(t):
    words = [w for w in norm(t).split(" ") if len(w) > 1 or w > "\uffff"]
    pairs = [run[k : k + 2] for run in regex.findall(f"[{HAN}]{{2,}}", norm(t)) for k in range(len(run) - 1)]
    return list(dict.fromkeys(words + pairs))


def topics(t, stop):
    long = [w for w in tokens(t) if len(w) >= (2 if regex.search(f"[{HAN}]", w) else 3) and w not in stop]
    return list(dict.fromkeys(long + [r for w in long for r in regex.findall("[a-z0-9]{3,}", w) if r not in stop]))


def hits(t, words):
    hay = f" {norm(t)} "
    return [w for w in words if norm(w) and (norm(w) in hay if regex.search(f"[{HAN}]", norm(w)) else f" {norm(w)} " in hay)]


def at_word(t, most):
    marks = f"[{S}，。、！？·,:;!?–—\"'()（）]+\\Z"
    if len(t) <= most:
        return t
    bare = regex.sub(marks, "", t[: most - 1])
    last = bare.rfind(" ")
    if last >= most // 2:
        return regex.sub(marks, "", bare[:last]) + "…"
    return (bare if len(bare) >= most // 2 else t[: most - 1]) + "…"


def full_summary(body, lang):
    found = first_sentence(body, MOST["summary"][lang])
    if len(found) >= MOST["least"][lang]:
        return found
    parts, n = [found], len(found)
    for s in sentences(without_metadata(body)):
        if n < MOST["least"][lang] and not any(s in p for p in parts):
            parts.append(s)
            n += len(s) + 1
    return cut(" ".join(parts), MOST["summary"][lang])


def hooks(title, text, stop, domain, lang):
    most, told, top = MOST["hook"][lang], sentences(text), topics(f"{title} {text}", stop)[:3]
    card = " · ".join(top)
    lead, second = (cut(told[k], most) if len(told) > k else "" for k in (0, 1))
    own = [(lead, True), (cut(card, most), False), (second, True), (cut(f"{domain}｜{card}", most) if card else "", False), (cut(f"{top[0]}：{told[0]}", most) if top and told else "", True)]
    bare = lambda t: strip(regex.sub("…\\Z", "", t))

    def echoes(t):
        mine = tokens(bare(t))
        return bool(mine) and len([w for w in mine if w in tokens(title)]) / len(mine) >= 0.8

    cards = [(strip(t), s and echoes(strip(t))) for t, s in own]
    if cards[0][1] and cards[0][0]:
        cards = [cards[2], cards[1], cards[3], cards[4]]
    fit = [(t, e) for t, e in cards if len(t) >= 12 and not (bare(t) and title.startswith(bare(t)) and len(bare(t)) >= 0.6 * len(title))]
    return list(dict.fromkeys([t for t, e in fit if not e] + [t for t, _ in fit]))[:3]


def reason(title, body, keywords, signals, domain):
    found, signal = hits(f"{title} {body}", keywords)[:2], (hits(f"{title} {body}", signals) or [""])[0]
    outlet = "[A-Z][A-Za-z0-9.'’&]*"
    subject = strip(regex.sub(f"[{S}]+[-–—|][{S}]+{outlet}(?:[{S}]+{outlet}){{0,3}}[{S}]*\\Z", "", strip(title or body)))
    subject = strip(regex.sub(f"[。．.!?！？:：,，、{S}…]+\\Z", "", first_sentence(subject, 400)))
    subject = at_word(collapse(regex.sub("[0-9]+[.,][0-9]+", " ", subject)), 28)
    if language(f"{title}\n{body}") == "zh":
        listed = "".join(f"「{k}」" for k in found)
        if found:
            return f"聚焦你的关注点 {listed}" + (f"，并出现强信号「{signal}」" if signal else "")
        return f"出现领域信号「{signal}」" if signal else f"因「{subject}」入选" if subject else f"与「{domain}」相关"
    if found:
        return f'Matches your interests in {", ".join(found)}, with a strong "{signal}" signal' if signal else f"Matches your interest in {', '.join(found)}"
    return f'Strong "{signal}" signal in {domain}' if signal else f"Picked for {subject}" if subject else f"Related to your {domain} feed"


def post(title, body, keywords, signals, stop, domain="prose", persona="daily", display=""):
    why = strip(reason(title, body, keywords, signals, domain))
    title = cut(collapse(without_tags(regex.sub("^[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+:[ \t\n\x0b\f\r]+", "", title))), 120)
    body = without_metadata(without_tags(body))
    lang = language(f"{title}\n{body}")
    if not why or regex.search("[0-9]\\.[0-9]", why):
        why = f"Hand-picked from the {domain} feed by {persona}" if lang == "en" else f"{display}为你挑的深度内容"
    summary = full_summary(body, lang)
    return title, hooks(title, without_metadata(summary or title), stop, domain, lang), summary, at_word(why, 40), lang


def test_every_page_is_rendered_as_by_a_plain_reading(spark, sf_dir):
    items = from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()
    want = {f"daily:d1:{r.seq}": post(r.title, r.body, queries.KEYWORDS, queries.SIGNALS, queries.CONFIG.stopwords) for r in items}
    got = {r.id: (r.title, r.hooks, r.summary, r.why, r.lang) for r in queries.QUERIES["rendered_posts"](spark, sf_dir).collect()}
    assert got == want and len(got) > 20


ODD = [
    ("", ""), ("Only a title that is long enough for a hook", ""), ("", "Only a body, with one sentence. And another one here!"), ("owner/repo: A tool for ships", "arXiv:2609.1 Announce Type: new Abstract: Ships sail far. " * 9),
    ("A title told again", "A title told again. A second sentence that says something new! A third one, longer than the others by far?"), ("深海发现新的物种", "科学家在深海发现了新的物种，这是今年最重要的发现之一。它生活在三千米以下的黑暗之中！研究仍在继续。" * 12),
    ("Plain " * 40, "x" * 1000), ("<b>Bold</b> &amp; 3.5 better - Daily News", "<p>para and para</p><script>alert(1)</script> " + "Thing after thing happens 1.25 times. " * 30), ("🚀🚀 launch", "🚀 up. " * 80), ("Version 2.5, of 3,1 - Wire", "."),
]


@pytest.mark.parametrize("keywords,signals", [(["thing", "深海"], ["para"]), ([], [])])
def test_odd_items(spark, keywords, signals):
    rows = spark.createDataFrame([(str(k), t, b, f"https://a.example/{k}", 0, "s", str(k), k) for k, (t, b) in enumerate(ODD)], "id string, title string, body string, url string, published_at long, source string, event_key string, pos long")
    got = {r.pos: (r.title, r.hooks, r.summary, r.why, r.lang) for r in render.rendered(rows, "daily", "d", "prose", keywords, signals, ["the", "and"]).collect()}
    for k, (title, body) in enumerate(ODD):
        assert got[k] == post(title, body, keywords, signals, ["the", "and"]), k
