"""Page extraction and chat rendering against hand-made cases and brute force."""

import pytest

from pulsewatch.llm import chat, pages

ARTICLE = "<h1>A &amp; B</h1><p>One\n <b>two</b>&nbsp;three<p>Four<br>five<ul><li>six<li>seven</ul>"
WANT = "A & B\nOne two three\nFour five\nsix\nseven"
NOISE_BEFORE = '<header><h1>Site name</h1><div>Log in</div></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>'
NOISE_AFTER = '<section id="comments"><p>A long reader comment that nobody needs here</p></section><aside><p>Read this too</p></aside><footer>&copy; x</footer>'
TEMPLATES = {
    "article": "<article>{}</article>",
    "classes": '<div id="wrap"><div class="layout"><div class="post-{n} entry">{}</div></div></div>',
    "main": '<main role="main"><section class="text">{}<div class="ad">Buy now</div><form><p>Your mail</p></form></section></main>',
}


def page(template, body=ARTICLE, n=1):
    inner = TEMPLATES[template].replace("{n}", str(n)).replace("{}", body)
    return (
        f'<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="home widget">'
        f"{NOISE_BEFORE}<!-- <p>no</p> -->{inner}{NOISE_AFTER}</body></html>"
    )


@pytest.mark.parametrize("template", TEMPLATES)
def test_main_text_of_templates(template):
    parsed = pages.parse(page(template))
    assert pages.text_by(parsed, pages.best(pages.scores(parsed))) == WANT


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain < 3 &lt; text", "plain < 3 < text"),
        ("<body><p>a<p>b", "a\nb"),
        ("<body><article><p>cut off in a ta", "cut off in a ta"),
        ("<body><article><p>cut <b", "cut"),
        ("<body><article><p>x</p><script>never closed", "x"),
        ("<body><article><p title='a > b'>y</p></article>", "y"),
        ("<body><article><p>a</span></div>b</p></article>", "ab"),
        ("<body><div><table><tr><td>1<td>2<tr><td>3</table></div>", "1 2\n3"),
        ("<body><article><header><h1>T</h1><p>by me</p></header><p>z</p></article>", "T\nz"),
        ("<body><article><p hidden>h</p><p>v</p><div aria-hidden='true'>h</div></article>", "v"),
        ("<body><article><p>" + "w " * 50000 + "</p></article>", ("w " * 50000).strip()),
    ],
)
def test_parsing(html, text):
    parsed = pages.parse(html)
    path = pages.best(pages.scores(parsed))
    got = pages.text_by(parsed, path) if path else "\n".join(b.text for b in parsed.blocks)
    assert got == text


LONG = ARTICLE + "<p>" + "A sentence that is part of the story. " * 20 + "</p>"
LONG_WANT = WANT + "\n" + ("A sentence that is part of the story. " * 20).strip()


@pytest.mark.parametrize(
    "wrapper",
    [
        "<article class='post has-sidebar'>{}</article>",
        "<article class='story-widget'>{}</article>",
        "<main id='search'>{}</main>",
        "<div class='no-sidebar'>{}</div>",
        "<div class='ad-free'><div>{}</div></div>",
        "<div class='content-widget'>{}</div>",
        "<div id='page' class='with-comments'>{}</div>",
        "<div class='search-result'>{}</div>",
        "<div class='content header-fixed'>{}</div>",
        "<div class='header-fixed'><div>{}</div></div>",
        "<div class='widget'><article>{}</article></div>",
        "<div class='widget'>{}</div>",
    ],
)
def test_wrappers_named_after_what_is_left_out(wrapper):
    comments = "<section id='comments'><p>" + "a reader has much to say " * 60 + "</p></section>"
    for body in (wrapper.format(LONG), wrapper.format(LONG + comments), wrapper.format(LONG) + comments):
        parsed = pages.parse(f"<html><body>{NOISE_BEFORE}{body}{NOISE_AFTER}</body></html>")
        assert pages.text_by(parsed, pages.best(pages.scores(parsed))) == LONG_WANT


def test_hosts_vote(spark):
    rows = [(i, f"https://www.a.org/p/{i}", page("classes", n=i)) for i in range(6)]
    # on one page of the host another container looks better by itself
    long_ad = "<div class='x'><p>" + "promising offers without end " * 40 + "</p></div>"
    rows.append((6, "https://WWW.a.org:80/p/6", page("classes", n=6).replace("<section id", long_ad + "<section id")))
    rows += [(7, "http://b.org", page("article")), (8, None, page("main")), (9, "http://b.org/x", None), (10, "no url", ""), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as path", "2 as host", "3 as `a b`")
    got = pages.extracted(df).select("row.*", "text").collect()
    assert len(got) == len(rows) and {"path", "host", "a b"} <= set(got[0].asDict())
    for r in got:
        assert r["text"] == ("" if r["page_id"] in (9, 10) else WANT)
    assert pages.extracted(df.limit(0)).count() == 0
    assert dict(pages.host_paths(df).collect())["www.a.org"].endswith("/div.layout/div.entry.post-#")


def test_hosts_of_several_templates(spark):
    def story(n):
        return f"<p>{f'Story {n} goes on and on. ' * 30}</p>"

    def want(n):
        return (f"Story {n} goes on and on. " * 30).strip()

    blog = "<div class='post'>{}</div>"
    # the winner of the host is a small box on the pages of the forum and of the old layout
    forum = "<div class='post'><p>Rules of this board</p></div><div class='board'><div class='thread'>{}</div></div>"
    old = "<div class='post'><p>From our archive</p></div><table><tr><td class='c'>{}</table>"
    split = "<div class='post'>{}</div><div class='text-more'>{}</div>"
    rows = [(n, "http://h.org/x", blog.format(story(n))) for n in range(12)]
    rows += [(n, "http://h.org/x", forum.format(story(n))) for n in range(12, 16)]
    rows += [(16, "http://h.org/x", old.format(story(16))), (17, "http://h.org/x", split.format(story(17), story(99)))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extracted(df).select("row.page_id", "text").collect()}
    assert got == {n: want(n) for n in range(17)} | {17: want(17) + "\n" + want(99)}
    assert {w["path"].rpartition(".")[2] for w in pages.host_winners(df).head()["winners"]} == {"post", "thread"}


def render(turns, speaker):
    text, mask = "", []
    for _, role, body in sorted(set(turns), key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])):
        if role == "system":
            text += "<|system|>\n"
        elif role == speaker:
            text += "<|assistant|>\n"
        else:
            text += f"<|user name={role}|>\n"
        start = len(text)
        text += f"{body}<|end|>\n"
        if role == speaker:
            mask.append((start, len(text)))
    return text, mask


CHAT = "conv_id long, turn long, role string, text string"


def test_rotation_equals_brute_force(spark):
    rows = [(c, t, ["ann", "bob", "system", "çe"][(c + t) % 4], f"hé {c} {t} 𝔘") for c in range(5) for t in range(c + 1)]
    rows += [(9, t, "ab"[t % 2], f"t{t}") for t in range(150)] + [rows[3]]
    got = chat.rotated(spark.createDataFrame(rows, CHAT).selectExpr("*", "1 as said", "2 as speaker")).collect()
    seen = set()
    for r in got:
        own = [(t, role, text) for c, t, role, text in rows if c == r["conv_id"]]
        text, mask = render(own, r["speaker"])
        assert r["text"] == text and [(m["start"], m["end"]) for m in r["mask"]] == mask
        assert (r["n_turns"], r["n_trained"]) == (len(set(own)), len(mask))
        seen.add((r["conv_id"], r["speaker"]))
    assert seen == {(c, role) for c, _, role, _ in rows if role != "system"} and len(got) == len(seen)


def test_rotation_edges(spark):
    rows = [(1, 0, "system", "only"), (2, None, None, None), (2, 1, "", "x"), (None, 0, "a", "lone"), (None, 0, "b", "lone"), (3, 0, "a<|b", "say <|end|> now"), (3, 0, "a<|b", "again")]
    got = chat.rotated(spark.createDataFrame(rows, CHAT)).collect()
    by = {(r["conv_id"], r["speaker"]): r for r in got}
    assert set(by) == {(2, "unknown"), (None, "a"), (None, "b"), (3, "a< |b")}
    assert by[3, "a< |b"]["text"] == "<|assistant|>\nagain<|end|>\n<|assistant|>\nsay < |end|> now<|end|>\n"
    assert by[2, "unknown"]["text"] == "<|assistant|>\n<|end|>\n<|assistant|>\nx<|end|>\n"
    assert chat.rotated(spark.createDataFrame([], CHAT)).count() == 0


def test_whole_dialogues_for_every_participant(spark):
    rows = [(1, t, "ab"[t % 2], f"t{t}") for t in range(1, 150)] + [(1, 0, "system", "rules"), (1, 70, "c", "only here")]
    rows += [(2, 100 * t, "ab"[t % 2], f"sparse {t}") for t in range(5)] + [(2, None, "d", "before all")]
    got = {(r["conv_id"], r["speaker"]): r for r in chat.rotated(spark.createDataFrame(rows, CHAT)).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (2, "d")}
    for (conv, speaker), r in got.items():
        own = [x[1:] for x in rows if x[0] == conv]
        text, mask = render(own, speaker)
        assert r["text"] == text and [(m["start"], m["end"]) for m in r["mask"]] == mask
        assert (r["n_turns"], r["n_trained"]) == (len(own), len(mask))
    assert chat.rotated(spark.createDataFrame([], CHAT)).count() == 0


def test_a_very_long_text_and_a_system_turn_far_ahead(spark):
    rows = [(1, 0, "system", "rules"), (1, 500, "a", "x" * 300_000), (1, 1000, "b", "short")]
    got = {r["speaker"]: r for r in chat.rotated(spark.createDataFrame(rows, CHAT)).collect()}
    for speaker, r in got.items():
        text, mask = render([x[1:] for x in rows], speaker)
        assert r["text"] == text and [(m["start"], m["end"]) for m in r["mask"]] == mask


def test_rows_without_a_number_or_a_dialogue_stay(spark):
    rows = [(None, 0, "a", "lone")] * 3 + [(1, None, "a", "yes")] * 2 + [(1, None, "b", "no"), (1, 4, "b", "hm"), (1, 4, "b", "hm")]
    df = spark.createDataFrame(rows, CHAT)
    got = chat.rotated(df).collect()
    assert sum(r["conv_id"] is None for r in got) == 3
    one = {r["speaker"]: r for r in got if r["conv_id"] == 1}
    yes, no, hm = "<|assistant|>\nyes<|end|>\n", "<|user name=b|>\nno<|end|>\n", "<|user name=b|>\nhm<|end|>\n"
    assert one["a"]["text"] == yes + yes + no + hm
    assert (one["a"]["n_turns"], one["a"]["n_trained"], one["b"]["n_trained"]) == (4, 2, 2)


BODY = "<h1>The head line</h1><p>First paragraph of the story, long enough to be one.</p><p>Second paragraph, just as long as that.</p>"
BODY_TEXT = "The head line\nFirst paragraph of the story, long enough to be one.\nSecond paragraph, just as long as that."


@pytest.mark.parametrize(
    "html",
    [
        f'<article data-title="The hidden cost of things">{BODY}</article>',
        f'<article data-hidden="false">{BODY}</article>',
        f'<article data-role="navigation">{BODY}</article>',
        f'<article style="overflow: hidden ;x:y">{BODY}</article>',
        f"<article title='role=navigation hidden'>{BODY}</article>",
        f"<body><form action='/x' method=post><div>{BODY}</div></form></body>",
        f"<body><form><nav>Menu</nav><main>{BODY}</main><footer>Foot</footer></form></body>",
        f'<body><div aria-hidden="true"><article>{BODY}</article></div><p>Small.</p></body>',
        f'<body><article>{BODY}</article><aside><p>Beside the story there is this.</p></aside></body>',
        f'<body><article>{BODY}</article><form><p>Sign up for our letter</p><input></form></body>',
        f'<body><article>{BODY}</article><div hidden><p>Hidden words here.</p></div></body>',
        f'<body><article>{BODY}</article><div role="complementary"><p>Beside the story.</p></div></body>',
        f"<body><table><tr><td>Menu</td><td>{BODY}</td></tr></table></body>",
        f"<body><table><tr><td><a href=x>Menu</a></td><td>{BODY}</td><td><p>Advert</p></td></tr></table></body>",
    ],
)
def test_marks_in_values_and_wrappers_lose_no_article(spark, html):
    rows = [(i, f"http://h{i % 2}/x", html) for i in range(3)]
    found = pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in found} == {BODY_TEXT}


def test_titles_of_links_do_not_hide_their_words(spark):
    html = f'<article>{BODY}<p>See <a title="a hidden gem" href="/x">this place</a> for more of it.</p></article>'
    row = pages.extracted(spark.createDataFrame([(1, "http://h/", html)], "page_id long, url string, html string")).first()
    assert row["text"] == BODY_TEXT + "\nSee this place for more of it."


def test_attributes_are_read_one_by_one():
    read = pages._attributes
    assert read(""" class="a b" id=x hidden data-id='y' CLASS=c """) == {"class": "a b", "id": "x", "hidden": "", "data-id": "y"}
    assert read(""" title="class=nav id=ad" role = 'main' a=b/c """) == {"title": "class=nav id=ad", "role": "main", "a": "b/c"}
    assert read(""" x="unclosed hidden role=form""") == {"x": "unclosed hidden role=form"}
    assert read("") == {} and read(" / ") == {}
