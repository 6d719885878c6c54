import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from claimsight.llm import main_text, neighbours, warc
from claimsight.session import work_path

PAGE = """<html><body><nav><a href=a>Menu</a></nav><div class="cookie-notice">Cookies!</div>
<article><h1>Title &amp; more</h1><p>First <b>bold</b>
paragraph of the text.<p>Second&nbsp;paragraph.</article><div class=comments><p>Nice!</p></div>
<form>x</form><footer>foot</footer><script>var t = "</p>";</script>"""


def test_main_text():
    assert main_text.main_text(PAGE) == "Title & more\nFirst bold paragraph of the text.\nSecond paragraph."
    assert main_text.main_text("") == "" and main_text.main_text("<p>one") == "one"
    assert main_text.main_text("<div>" * 2000 + "deep" + "</div>" * 2000) == "deep"


def test_wrappers_named_like_marks_keep_the_article():
    body = "<p>A long paragraph of the text, with words.</p>" * 5
    whole = main_text.main_text(f"<div class='x'>{body}</div>")
    assert whole.count("long paragraph") == 5
    for name in (
        "no-sidebar", "has-sidebar", "content-with-sidebar", "post hentry tag-food", "page nav-open",
        "has-comments", "legal-news",
    ):
        page = "<html><body>{}<div class='sidebar'><p>Short aside.</p></div></body></html>"
        assert main_text.main_text(page.format(f"<div class='{name}'>{body}</div>")) == whole
        inner = f"<div class='{name}'><article>{body}</article><div class='comments'><p>Nice!</p></div></div>"
        assert main_text.main_text(page.format(inner)) == whole


def test_tags_that_authors_leave_out():
    body = "<article><h1>Title</h1><p>A paragraph of the article, with words.</p></article>"
    want = "Title\nA paragraph of the article, with words."
    for page in (
        f"<html><head><title>x</title><body>{body}",
        f"<html><head><title>x</title>{body}",
        f"<html><body><form action=x>{body}<input name=a></form></body></html>",
        f"<html><body><nav><a href=x>Menu</a> {body}",
        f"<html><body><header><a href=x>Menu</a>{body}</header>",
    ):
        assert main_text.main_text(page) == want, page
    plain = "<div><p>A paragraph of plain text, with many words in it.</p><p>And one more of these.</p></div>"
    for page in (f"<head><title>x</title>{plain}", f"<form>{plain}</form>", f"<nav><a href=x>Menu</a>{plain}"):
        assert main_text.main_text(f"<html>{page}").endswith("And one more of these."), page


def test_comments_go_however_long():
    chat = "<p>I have a very long opinion about all of this and write it down here.</p>" * 20
    want = "Title\nA short article."
    head = "<h1>Title</h1><p>A short article.</p>"
    for page in (
        f"<article>{head}</article><div class=comments>{chat}</div>",
        f"<article>{head}</article><section id=comments><article>{chat}</article><article>{chat}</article></section>",
        f"<main>{head}</main><ol class='comment-list'><li>{chat}</li></ol>",
        f"<div class=has-comments><article>{head}</article><div class=comments>{chat}</div></div>",
        f"<article>{head}<section class=comments>{chat}</section></article>",
    ):
        assert main_text.main_text(f"<html><body>{page}</body></html>") == want, page
    assert "opinion" not in main_text.main_text(f"<body><div>{head}</div><div class=comments>{chat}</div>")
    side = f"<div class=sidebar><h1>Site</h1>{chat}</div>"
    assert main_text.main_text(f"<body>{side}<article>{head}</article>") == want


def test_unmatched_end_tags_are_cheap():
    import time

    page = "<span>" * 4000 + "text" + "</b>" * 8000
    started = time.perf_counter()
    assert main_text.main_text(page) == "text"
    assert time.perf_counter() - started < 2


def test_extract_keeps_all_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract(df).collect()
    assert sorted(r.n_chars for r in got) == [0, 64, 64] and len(got[0].text) == got[0].n_chars
    assert main_text.extract(df.limit(0)).count() == 0


def test_archives_come_back_whole(spark):
    big = "<p>é</p>" * 200_000
    rows = [(i, f"u{i} x", f"{i} " + "y" * (i % 250)) for i in range(300)]
    rows += [(1000, None, big), (999, "a\r\nb", big), (None, "n", big), (-5, "e", None), (7, "u7 x", rows[7][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = work_path(spark, "warc-test")
    warc.write_archives(df.repartition(2), path)
    got = warc.read_archives(spark, path, range_bytes=777).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == want
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds[999] == ("response", None) and kinds[1000] == kinds[None] == ("revisit", 999)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_archives_of_one_id_with_several_payloads(spark):
    rows = [(7, "u", "a" * 200), (7, "v", "b" * 300), (8, "w", "b" * 300), (9, "x", "a" * 200), (7, "u", "a" * 200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(df).collect())
    a, b = (hashlib.sha256(x.encode()).hexdigest() for x in ("a" * 200, "b" * 300))
    assert got == sorted(
        [(7, 200, a, "response", None)] * 2
        + [(7, 300, b, "response", None), (8, 300, b, "revisit", 7), (9, 200, a, "revisit", 7)]
    )


def test_neighbours_recall(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((1500, 16))
    base[1::3] = base[::3] + 0.05 * rng.standard_normal((500, 16))
    base[700:760] = base[700]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] + [1.0] * 15), (None, [1.0] * 16), (5050, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect()
    unit = base / np.linalg.norm(base, axis=1)[:, None]
    hit = 0
    for q in range(0, 1500, 50):
        cos = unit @ unit[q]
        cos[q] = -9
        best = cos[np.argsort(-cos)[:5]]
        mine = sorted((r.rank, r.score) for r in got if r.query_id == q)
        assert [r for r, _ in mine] == [1, 2, 3, 4, 5]
        hit += sum(s >= best[-1] - 1e-9 for _, s in mine)
    assert hit >= 0.9 * 150
    copies = [r.vec_id for r in sorted((r for r in got if r.query_id == 750), key=lambda r: r.rank)]
    assert copies == [700, 701, 702, 703, 704]
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_of_extreme_vectors(spark):
    rows = [(0, [1e-200, 0.0]), (1, [1e200, 1e200]), (2, [5e-324, 0.0]), (3, [-1e308, 1e308]), (4, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, cell int")
    got = {(r.query_id, r.vec_id): r.score for r in neighbours.nearest(df, F.lit(True)).collect()}
    plain = {0: (1, 0), 1: (1, 1), 2: (1, 0), 3: (-1, 1), 4: (1, 2)}
    assert len(got) == 20
    for (q, v), score in got.items():
        a, b = np.array(plain[q], float), np.array(plain[v], float)
        assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-15


def test_copies_in_all_leaves_are_seen():
    stop = neighbours.chi_square_quantile(neighbours.CONFIDENCE, neighbours.DIMENSIONS)
    axes = neighbours.projection(neighbours.DIMENSIONS, 64)
    for seed in range(12):
        rng = np.random.default_rng(seed)
        vector = rng.standard_normal(64)
        ids = rng.permutation(3000)
        points = pd.DataFrame({"vec_id": ids, "vector": [vector] * 3000})
        query = pd.DataFrame({"query_id": [5000], "vector": [vector], "bound": [float("inf")]})
        got = neighbours.search_cell(query, points, axes, stop, 5)
        assert got["vec_id"].tolist() == [0, 1, 2, 3, 4]
