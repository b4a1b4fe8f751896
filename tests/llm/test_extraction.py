"""Main texts of pages that were made from a known text."""

import random

from tableflow.llm import extraction, wrapper

PAGE = """<!DOCTYPE html><html lang=en><head><title>{title} | Site</title><script>var t="</p><article>";</script>
<style>p {{ margin: 0 }}</style></head><body class="x"><div class=top><a href="/">Home</a> <a href='/b'>About us</a></div>
<div class="sidebar-left"><ul><li><a href=/1>one {n}</a><li><a href=/2>two</a></ul></div>{extra}
<div id=main-{n}><h2>{title}</h2>{body}</div>
<div class="comments"><p>reader {n} says {long}</p></div><form><label>Mail</label><input></form>
<div>Terms of use apply. All rights reserved.</div></body>"""


def page(rng, n):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9)))
    title = f"{word()} & {word()}"
    parts = [" ".join(word() for _ in range(rng.randrange(8, 40))) for _ in range(rng.randrange(2, 9))]
    body = "".join(rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}</b></p>\n"]).format(p.replace(" ", rng.choice([" ", "\n  "]), 1)) for p in parts)
    extra = "<div class='cookie notice'><p>We use cookies</p></div>" if n % 3 == 0 else ""
    made = PAGE.format(title=title.replace("&", "&amp;"), n=n, body=body, extra=extra, long=" ".join(word() for _ in range(90)))
    return made, "\n".join([title, *parts])


def test_texts_of_one_host(spark):
    rng = random.Random(3)
    made = [page(rng, n) for n in range(40)]
    rows = [(n, f"https://u@A.example.org:80/{n}", html, "x") for n, (html, _) in enumerate(made)]
    got = extraction.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(4)).collect()
    assert {r.page_id: r.text for r in got} == {n: text for n, (_, text) in enumerate(made)}
    assert all(r.n_chars == len(r.text) for r in got)


def test_edge_cases(spark):
    rows = [(1, "http://a.b/1", None, 1), (None, None, "<p>x &lt; y</p><p>z", 1), (2, "no url", "plain   text &amp; more", 2),
            (3, "http://a.b/2", "", 3), (4, "http://c.d/", "<div>" * 5000 + "deep" + "</div>" * 10, 4), (4, "http://c.d/", "<a b='", 4),
            (5, "http://e.f/", "<p>" + "long " * 50_000, 5), (5, "http://e.f/", "<p>" + "long " * 50_000, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, verdicts int")
    got = sorted(map(tuple, extraction.main_texts(df).collect()), key=str)
    assert [(r[0], r[2]) for r in got if r[0] in (1, 3)] == [(1, ""), (3, "")]
    assert [r[2] for r in got if r[0] is None] == ["x < y\nz"] and [r[2] for r in got if r[0] == 2] == ["plain text & more"]
    assert "deep" in [r[2] for r in got if r[0] == 4] and [r[3] for r in got if r[0] == 5] == [249_999, 249_999]
    assert extraction.main_texts(df.limit(0)).count() == 0


def test_expressions():
    def of(*pages):
        found = None
        for p in pages:
            items = wrapper.infer(wrapper.parse(p))
            found = items if found is None else wrapper.merge(found, items)
        return found

    def shown(items):
        return " ".join((f"{x[1]}({shown(x[5])})" if x[0] == "e" else f"[{shown(x[5])}]" if x[0] == "g" else "T" if x[1] is None else "t")
                        + "+" * x[2] + "?" * x[3] for x in items)

    assert shown(of("<ul><li>a<li>b<li>c</ul>")) == "ul(li(T)+)"
    assert shown(of("<div>a</div>", "<div>a<br></div>")) == "div(t br()?)"
    assert shown(of("<div><h2>a</h2><p>b</p><h2>c</h2><p>d</p></div>", "<div><h2>a</h2><p>b</p></div>")) == "div([h2(T) p(T)]+)"
    assert shown(of("<b>x</b>y", "<i>z</i>y")) in ("b(t)? i(t)? t", "i(t)? b(t)? t")
    once = of("<div>a<br></div>", "<div>b</div>")
    assert shown(wrapper.merge(once, once)) == shown(once)


def prose(rng, count):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(count))


def texts_of(spark, pages):
    rows = [(n, f"http://a.example.org/{n}" if host else None, html) for n, (html, host) in enumerate(pages)]
    found = extraction.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


def test_two_templates_and_parts_of_an_article(spark):
    rng = random.Random(6)
    frame = "<body><div><a href=/>Home</a></div>{}<div>All rights reserved.</div></body>"
    for host in (True, False):  # pages without a host share one wrapper
        made = []
        for n in range(20):
            a, b, c = (prose(rng, k) for k in (60, 40, 5))
            if n % 10 < 6:
                made.append((f"<div class=post><h1>{c}</h1><p>{a}</p><p>{b}</p></div>", f"{c}\n{a}\n{b}"))
            else:
                made.append((f"<div class=product><p>{b}</p><p>{c}</p></div>", f"{b}\n{c}"))
        assert texts_of(spark, [(frame.format(html), host) for html, _ in made]) == [text for _, text in made]
    shapes = ["<article><section id=a><p>{}</p></section><section id=b><p>{}</p></section></article>",
              "<div class=post><h1>{}</h1><div class=body><p>{}</p></div></div>",
              "<div class=post><div class=lead>{}</div><div class=body><p>{}</p></div></div>"]
    for shape in shapes:
        parts = [(prose(rng, 12), prose(rng, 60)) for _ in range(8)]
        assert texts_of(spark, [(frame.format(shape.format(*p)), True) for p in parts]) == ["\n".join(p) for p in parts]


def test_copies_stay_whole(spark):
    rng = random.Random(7)
    title, parts = prose(rng, 6), [prose(rng, 30) for _ in range(3)]
    for tag in ("article", "div"):
        one = f"<body><{tag}><h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in parts) + f"</{tag}></body>"
        assert texts_of(spark, [(one, True)] * 4) == ["\n".join([title, *parts])] * 4
    quoted = f"<body><div class=post><h1>{title}</h1><p>{parts[0]}</p><blockquote>{parts[1]}</blockquote></div></body>"
    others = [(prose(rng, 5), prose(rng, 40)) for _ in range(30)]
    pages = [(f"<body><div class=post><h1>{a}</h1><p>{b}</p></div></body>", True) for a, b in others] + [(quoted, True)] * 3
    assert texts_of(spark, pages) == [f"{a}\n{b}" for a, b in others] + ["\n".join([title, *parts[:2]])] * 3


def test_texts_are_counted_on_all_distinct_pages(spark):
    rng = random.Random(8)
    note = "<div>Written by our readers.</div>"
    frame = "<body>{}<div class=post><h1>{}</h1><p>{}</p></div></body>"
    made = []
    for _ in range(60):
        title, text = prose(rng, 5), prose(rng, 40)
        with_note = frame.format(note, title, text)
        made.append((wrapper.page_id(wrapper.parse(with_note)), with_note, frame.format("", title, text), f"{title}\n{text}"))
    made.sort()
    # On the pages of the least ids only, so that no few of them may speak for the host.
    pages = [(with_note if n < 30 else plain, True) for n, (_, with_note, plain, _) in enumerate(made)]
    assert texts_of(spark, pages) == [("Written by our readers.\n" if n < 30 else "") + text for n, (*_, text) in enumerate(made)]
    # On nearly all distinct pages, whatever copies there are of those without it.
    pages = [(with_note if n < 55 else plain, True) for n, (_, with_note, plain, _) in enumerate(made)]
    assert texts_of(spark, pages + pages[-1:] * 60) == [text for *_, text in made] + [made[-1][3]] * 60


def test_pages_of_a_host_are_counted_once(spark):
    rng = random.Random(9)
    rows = [("a", f"<body><nav>{k}</nav><p>{prose(rng, 9)}</p></body>") for k in range(25)]
    copies = [("a", html.replace("<nav>", "<nav>again ")) for _, html in rows for _ in range(3)]
    df = spark.createDataFrame(rows + copies + rows[:7] + [("b", "")] * 5, "host string, html string").repartition(6)
    assert {r.host: r.pages for r in extraction.wrappers(df).collect()} == {"a": 25, "b": 1}
