from html import escape

import pytest

from tablewright.llm import html_extract


def page(k, n=3, head="<nav><ul><li><a href='/x'>Home {k}</a></ul></nav>", foot="<footer>&copy; {k} someone</footer>", open_="<article>", close="</article>"):
    body = "".join(f"<p>Paragraph {k} {i} with <b>bold</b>\n text &amp; &lt;signs&gt;" + ("</p>" if i % 2 else "<br>") for i in range(n))
    text = "\n".join([f"Title {k}"] + [f"Paragraph {k} {i} with bold text & <signs>" for i in range(n)])
    extra = f"<aside>Side {k}</aside><form><p>Name {k}</p><input></form><div class='comments'><p>Reader {k} says</p></div><div id=cookie-notice>We use {k}</div>"
    html = f"<!DOCTYPE html><html><head><title>T {k}</title><style>p{{a:b}}</style><script>var x='</p><p>no';</script></head><body>{head.format(k=k)}<!-- <p>no</p> -->{open_}<h1>Title {k}</h1>{body}{close}{extra}{foot.format(k=k)}</body></html>"
    return html, text


def run(spark, rows):
    df = spark.createDataFrame([(k, u, h, "x") for k, u, h in rows], "page_id long, url string, html string, text string")
    return {r.page_id: r for r in html_extract.extract_pages(df).collect()}


def test_article(spark):
    rows, want = [], {}
    for k in range(12):
        html, want[k] = page(k, 1 + k % 5)
        rows.append((k, f"https://host{k % 2}.example.com/{k}", html))
    got = run(spark, rows)
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_without_article_element(spark):
    rows, want = [], {}
    for k in range(6):
        html, want[k] = page(k, 4, open_="<div class='story'>", close="</div>")
        rows.append((k, f"https://plain.example.com/{k}", html))
    assert {k: r.text for k, r in run(spark, rows).items()} == want


def test_repeated_text_stays(spark):
    html, text = page(7, 3)
    got = run(spark, [(k, "http://copies.example.com/a", html) for k in range(5)] + [(9, "http://alone.example.org/", html)])
    assert {r.text for r in got.values()} == {text}


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("no markup at all", ""),
        ("<article><p>cut off &am", "cut off &am"),
        ("<article><h1>A</h1><p>a<br>b</p><p> \n </p><p>&nbsp;c&#233;</p></article>", "A\na b\ncé"),
        ("<body><nav>menu</nav><main><p>in main</p></main></body>", "in main"),
        ("<article><p>x</p><script>if (a < b) {}</script><p>y</p><div class='ad'>buy</div></article>", "x\ny"),
    ],
)
def test_single_pages(spark, html, text):
    r = run(spark, [(1, None, html)])[1]
    assert (r.text, r.url) == (text, None)


def test_long_page_and_no_rows(spark):
    html = "<article>" + "".join(f"<p>{escape('a < b')} {i}</p>" for i in range(20_000)) + "</article>"
    assert run(spark, [(1, "http://a/", html)])[1].text.count("\n") == 19_999
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_classes(spark):
    rows = [(k, "http://h.example.com/", page(k)[0]) for k in range(5)]
    df = spark.createDataFrame([(k, "h.example.com", h) for k, _, h in rows], "row long, host string, html string")
    found = html_extract.templates(df)
    largest = found.groupBy("class").count().orderBy("count", ascending=False).first()
    assert largest["count"] >= 10  # the frame: html, head, body, nav, article and their ends occur once in each page


def test_all_slots_without_article_element(spark):
    """Title, lead and story are slots of three elements; with and without a template."""
    html = "<body><nav>Menu</nav><h1>Title {k}</h1><div class=lead>Lead {k}</div><div class=story><section><p>One {k}</p></section><section><p>Two {k} is longer</p></section></div><footer>Foot</footer></body>"
    want = {k: f"Title {k}\nLead {k}\nOne {k}\nTwo {k} is longer" for k in range(6)}
    rows = [(k, "https://slots.example.com/" if k else "https://single.example.org/", html.format(k=k)) for k in range(6)]
    assert {k: r.text for k, r in run(spark, rows).items()} == want


def test_template_text_is_no_slot(spark):
    """Boilerplate without a telling name, inside the article and without one."""
    for open_, close in (("<article>", "</article>"), ("<div>", "</div>")):
        rows = [(k, "https://own.example.com/", f"<body>{open_}<h1>Title {k}</h1><p>Paragraph {k} of the story</p><div class=x><p>Read more here</p></div>{close}</body>") for k in range(5)]
        assert {k: r.text for k, r in run(spark, rows).items()} == {k: f"Title {k}\nParagraph {k} of the story" for k in range(5)}


def test_names_around_an_article(spark):
    wrapped = "<body><form><div class='page sidebar'><article><p>Inside</p><div class=ad>buy</div></article></div></form></body>"
    both = "<body><article><p>Story</p></article><div class=comments><article><p>Reader</p></article></div></body>"
    got = run(spark, [(1, None, wrapped), (2, None, both)])
    assert (got[1].text, got[2].text) == ("Inside", "Story")


def test_invalid_classes(spark):
    """Tokens with equal vectors that come in another order on half of the pages are no template."""
    three = ["<section><p>A</p></section>", "<dl><dt>B</dt></dl>", "<pre>C</pre>"]
    pages_ = [(k, "h", f"<body><div><h1>{k}</h1>{''.join(three if k % 2 else three[::-1]) if k < 8 else ''}</div></body>") for k in range(12)]
    found = html_extract.templates(spark.createDataFrame(pages_, "row long, host string, html string")).collect()
    roles = {t.role for t in html_extract.read(pages_[1][2]) if t.tag in ("section", "dl", "pre")}
    assert found and not roles & {r.role for r in found}


def brute_templates(pages):
    """Classes by whole occurrence vectors, host by host, and the checks of the second pass written out."""
    out = {}
    for host in {h for _, h, _ in pages}:
        read = [[t for t in html_extract.read(html) if t.role] for _, h, html in pages if h == host]
        roles = {t.role for p in read for t in p}
        vector = {r: tuple(sum(t.role == r for t in p) for p in read) for r in roles}
        support = {r: sum(n > 0 for n in v) for r, v in vector.items()}
        most = max((n for r, n in support.items() if r % 2 == 0), default=0)
        kept = {r for r in roles if support[r] >= html_extract.SUPPORT and (r % 2 == 0 or 2 * support[r] >= most)}
        classes = {}
        for r in kept:
            classes.setdefault(vector[r], []).append(r)
        classes = {v: rs for v, rs in classes.items() if len(rs) >= html_extract.SIZE}
        place = {r: sum(min(k for k, t in enumerate(p) if t.role == r) for p in read if any(t.role == r for t in p)) / support[r] for r in kept}
        frame = {r for v, rs in classes.items() for r in rs if sum(v) == support[rs[0]] == most}

        def ordered(p, rs):
            seen = [t.role for t in p if t.role in rs]
            one = sorted(set(seen), key=lambda r: (place[r], r))
            return seen == one * (len(seen) // len(one))

        for v, rs in classes.items():
            on = [p for p, n in zip(read, v, strict=True) if n]
            if 10 * sum(not ordered(p, rs) for p in on) > len(on):
                continue
            gaps = set()
            for p in on:
                if not (set(rs) & frame) and ordered(p, rs) and all(ordered(p, x) for w, x in classes.items() if set(x) <= frame):
                    gaps |= {sum(t.role in frame for t in p[:k]) for k, t in enumerate(p) if t.role in rs}
            if len(gaps) <= 1:
                out[host, frozenset(rs)] = True
    return set(out)


def test_classes_by_brute_force(spark):
    import random

    random.seed(11)
    blocks = ["<section><p>A</p><p>B</p></section>", "<dl><dt>x</dt><dd>y</dd></dl>", "<table><tr><td>c</td></tr></table>", "<ul><li>n</li></ul>", "<pre>z</pre>", "<blockquote><p>q</p></blockquote>"]
    pages_ = []
    for k in range(60):
        inner = "".join(b for b in blocks if random.random() < 0.8)
        if random.random() < 0.2:
            inner = "".join(random.sample(blocks, 4))
        pages_.append((k, f"h{k % 4}", f"<body><nav>menu</nav><div><h1>t{k}</h1>{inner}<p>own {k}</p></div><footer>foot</footer></body>"))
    found = html_extract.templates(spark.createDataFrame(pages_, "row long, host string, html string")).collect()
    got = {}
    for r in found:
        got.setdefault((r.host, r["class"]), set()).add(r.role)
    assert {(h, frozenset(rs)) for (h, _), rs in got.items()} == brute_templates(pages_)


def test_templates_decide(spark, monkeypatch):
    """No telling tag or class: what the pages share is known by the template alone; joined templates give the same."""
    rows = [(k, "https://plain.example.com/", f"<body><div><p>Welcome to the site</p></div><div><h1>Title {k}</h1><p>Body {k} of it, a good deal longer than all that stands on every page of this site</p></div><div><p>All about us</p></div></body>") for k in range(6)]
    want = {k: f"Title {k}\nBody {k} of it, a good deal longer than all that stands on every page of this site" for k in range(6)}
    assert {k: r.text for k, r in run(spark, rows).items()} == want
    assert html_extract.extract(rows[0][2], {}) == f"Welcome to the site\n{want[0]}\nAll about us"
    monkeypatch.setattr(html_extract, "BROADCAST_ROWS", 0)
    assert {k: r.text for k, r in run(spark, rows).items()} == want


def test_equal_ids_are_extracted_one_by_one(spark):
    df = spark.createDataFrame([(1, "http://a/", "<p>one</p>"), (1, "http://a/", "<p>two</p>"), (1, "http://a/", "<p>one</p>"), (None, None, None)], "page_id long, url string, html string")
    assert sorted(r.text for r in html_extract.extract_pages(df).collect()) == ["", "one", "one", "two"]
