import html as std
import re

from weftgraph.llm import pages

SF = "/root/testdata/sf0.01"


def test_articles_of_the_test_pages(spark):
    table = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for row in table.collect():
        body = re.search(r"<article>(.*?)</article>", row.html, re.DOTALL)[1]
        parts = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>", "\n", body.replace("<br>", " "))).split("\n")
        want[row.page_id] = "\n".join(x for x in (" ".join(std.unescape(p).split()) for p in parts) if x)
    assert {r.page_id: r.text for r in pages.extract(table).collect()} == want


def main(html):
    found = pages.blocks(html)
    return found.main() or found.texts


def test_markup():
    assert main("<article><h1>A &amp; B</h1><p>x<b>y</b>\n z<br>w</article>") == ["A & B", "xy z w"]
    assert main("<main><header>no</header><p>a</p><aside>no</aside><form>no</form>b</main>c") == ["a", "b"]
    assert main("<body><nav>no</nav><div class='cookie-notice'>no<p>no</p></div><p>yes</p><div id=comments><article>no</article></div>") == ["yes"]
    assert main("<article><header><h1>Title</h1></header><p>t</p><section class='comments'><p>no</p></section></article>") == ["Title", "t"]
    assert main("<p>1 < 2</p><script>var t = '</p>';</script><style>p{}</style><!-- <p>no</p> --><p>b") == ["1 < 2", "b"]
    assert main('<div role="main"><p>a</p></div><p>b</p><p hidden>no</p><p style="display: none">no</p>') == ["a"]
    assert main("<table><tr><td>a</td><td>b</td></tr><tr><td>c</table><ul><li>d<li>e</ul>") == ["a b", "c", "d", "e"]
    assert main("") == [] and main("plain  text") == ["plain text"] and main("<p>a<script>never closed") == ["a"]
    assert main('<p title="a > b">x</p><a href="unclosed>y</a>') == ["x", "y"]


def longest(a, b):
    if not a or not b:
        return 0
    return 1 + longest(a[1:], b[1:]) if a[0] == b[0] else max(longest(a[1:], b), longest(a, b[1:]))


def test_shared_lines_are_a_longest_common_subsequence():
    import random

    rng = random.Random(0)
    for _ in range(100):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 7))] for _ in range(2))
        found = sorted(pages.shared(a, b))
        rest = iter(b)
        assert len(found) == longest(a, b) and all(any(a[i] == x for x in rest) for i in found)


def test_pages_without_an_article_lose_what_their_neighbour_has(spark):
    page = lambda *lines: "".join(f"<p>{x}</p>" for x in lines)
    rows = [
        (1, "http://h.org/a/1", page("Menu", "one", "Imprint")),
        (2, "http://h.org/a/2?x", page("Menu", "two", "Imprint")),
        (2, "http://h.org/a/2?x", page("Menu", "two", "Imprint")),
        (3, "http://other.org/a/1", page("Menu", "three", "Imprint")),
        (4, "http://h.org/b", "<article><p>Menu</p><p>four</p></article>"),
        (5, None, page("Menu", "five")),
        (6, "no url", None),
        (7, "http://h.org/a/3", ""),
        (None, "http://x.org/", page("x " * 100_000)),
    ]
    table = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, _page int, text string")
    found = sorted(((r.page_id, r.text) for r in pages.extract(table.coalesce(1)).collect()), key=str)
    want = [(1, "one"), (2, "two"), (2, "two"), (3, "Menu\nthree\nImprint"), (4, "Menu\nfour"), (5, "Menu\nfive"), (6, ""), (7, ""), (None, ("x " * 100_000).strip())]
    assert found == sorted(want, key=str)
    assert pages.extract(table.limit(0)).count() == 0


def test_marked_pages_are_aligned_too(spark):
    """An article that the next page repeats is not the page's own; lines shared within the page's own article stay."""
    teaser = "<article><p>Read on</p><p>Teaser</p></article>"
    own = lambda *lines: "<article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article>"
    rows = [
        (1, "http://h.org/a/1", "<p>Top</p>" + own("Title", "one", "Read on") + teaser),
        (2, "http://h.org/a/2", "<p>Top</p>" + own("Title", "two", "Read on") + teaser),
        (3, "http://k.org/a/1", "<p>Top 3</p>" + own("same")),
        (4, "http://k.org/a/2", "<p>Top 4</p>" + own("same")),
        (5, None, own("five") + teaser),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {1: "Title\none\nRead on", 2: "Title\ntwo\nRead on", 3: "same", 4: "same", 5: "five\nRead on\nTeaser"}
    assert {r.page_id: r.text for r in pages.extract(table).collect()} == want


def one_by_one(rows):
    """Main texts of pages without marked parts, each page looked up beside its neighbours in one sorted list."""
    from os.path import commonprefix

    split = [(url.split("/", 3)[2], "/" + url.split("/", 3)[3], n, pages.blocks(html).texts) for n, url, html in rows]
    order = sorted({(h, p, n, tuple(t)) for h, p, n, t in split if t}, key=lambda x: x[:3])
    texts = {}
    for h, p, n, lines in order:
        i = order.index((h, p, n, lines))
        different = lambda x: x[3] != lines
        # Copies in a row are passed over; a page of another host ends the search.
        before = next((x for x in reversed(order[:i]) if x[0] != h or different(x)), None)
        after = next((x for x in order[i + 1 :] if x[0] != h or different(x)), None)
        near = [x for x in (before, after) if x and x[0] == h]
        best = max(near, key=lambda x: len(commonprefix([x[1], p])), default=None)
        gone = pages.shared(list(lines), list(best[3])) if best else ()
        texts[n] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return [(n, texts.get(n, "")) for n, *_ in rows]


def test_texts_do_not_depend_on_partitions(spark):
    import random

    rng = random.Random(4)
    page = lambda *lines: "".join(f"<p>{x}</p>" for x in lines)
    rows = [(i, f"http://h.org/{rng.choice('abc')}/{i}", page("Menu", f"sec {i // 6}", f"body {i}", "Imprint")) for i in range(60)]
    rows += [(100 + i, f"http://h.org/copy/{i}", page("Menu", "same", "Imprint")) for i in range(40)]
    rows += [(200 + i, f"http://k.org/{rng.randint(0, 9)}", page(*rng.choices("pqrs", k=rng.randint(0, 4)))) for i in range(30)]
    rows += [(300, "http://alone.org/x", page("Menu", "alone")), (5, rows[5][1], rows[5][2])]
    want = sorted(one_by_one(rows))
    for parts in (1, 7, 60):
        table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        assert sorted(map(tuple, pages.extract(table).select("page_id", "text").collect())) == want
    ids = spark.createDataFrame([((float(n), n), u, h) for n, u, h in rows], "page_id struct<a:double,b:long>, url string, html string")
    assert sorted((r.page_id.b, r.text) for r in pages.extract(ids).collect()) == want


def test_texts_are_not_written_to_the_checkpoint_folder(spark):
    """They are read again from the pages and written once, in the last shuffle."""
    import random
    from pathlib import Path

    from weftgraph.operators.runtime import checkpoint_dir

    rng = random.Random(5)
    body = lambda: " ".join(rng.choice(("tree", "river", "mountain", "cloud")) for _ in range(2000))
    rows = [(i, f"http://h.org/{i}", f"<p>{body()}</p><p>{body()}</p><p>Imprint</p>") for i in range(60)]
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = {f for f in folder.rglob("*") if f.is_file()}
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    size = sum(f.stat().st_size for f in folder.rglob("*") if f.is_file() and f not in before)
    assert 0 < size < sum(len(r[2]) for r in rows) / 10
    assert {r.page_id: r.text for r in found.collect()} == {i: html[3:].split("</p><p>Imp")[0].replace("</p><p>", "\n") for i, _, html in rows}
