"""Hosts of copies, of few pages, and of articles that share a heading."""

from tableferry.llm import templates

ARTICLE = "<html><body><div>Site %s</div><article><h1>Head</h1><p>One</p><p>Two</p></article></body></html>"
SHARED = "<html><body><article><h1>Head %d</h1><p>Text %d</p><h2>Results</h2><p>More %d</p></article></body></html>"
PLAIN = "<html><body><div class='x'><p>Site line</p><p>Own text %d</p></div></body></html>"


def test_copies_small_hosts_and_shared_headings(spark):
    rows = [(i, f"http://copies.example/{i}", ARTICLE % i) for i in range(5)]
    rows += [(10 + i, f"http://heads.example/{i}", SHARED % (i, i, i)) for i in range(6)]
    rows += [(20 + i, f"http://two.example/{i}", PLAIN % i) for i in range(2)]
    rows += [(30 + i, f"http://three.example/{i}", PLAIN % i) for i in range(3)]
    rows += [(40 + i, f"http://same.example/{i}", PLAIN % 1) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in templates.main_text(pages).collect()}
    assert {found[i] for i in range(5)} == {"Head\n\nOne\n\nTwo"}
    for i in range(6):
        assert found[10 + i] == f"Head {i}\n\nText {i}\n\nResults\n\nMore {i}"
    assert [found[20], found[21]] == ["Own text 0", "Own text 1"]
    assert [found[30 + i] for i in range(3)] == [f"Own text {i}" for i in range(3)]
    assert {found[40 + i] for i in range(3)} == {"Site line\n\nOwn text 1"}
