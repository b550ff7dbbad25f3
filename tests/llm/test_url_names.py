"""The labelled names of operator 1: not the hosts it is run on, and how it does on names held out."""

import re

from barloom.llm import urls
from barloom.llm.queries import table

SF = "/root/testdata/sf0.01"


def test_labelled_hosts_are_not_those_of_the_pages(spark):
    names = lambda url: re.sub(r"^.*?://([^/?#]*).*$", r"\1", url or "")
    bare = lambda host: re.sub(r"^(www|m|blog)\.|\.(example\.(com|net|org)|test)$", "", host)
    given = {bare(bare(names(r.url))) for r in table(spark, SF, "pages").select("url").collect()}
    assert not given & {bare(bare(names(url))) for url, _ in urls.EXAMPLES}


def test_recall_on_names_and_words_held_out(spark):
    kept_out = [e for k, e in enumerate(urls.EXAMPLES) if k % 10 == 0]
    held = [(re.sub(r"(?<=[a-z])[-.](?=[a-z]+[.]test)", "", u), b) for u, b in kept_out]  # host words run together
    hidden = {w for line in (*urls.BLOCKED, *urls.ALLOWED) for w in line.split()[::5]}
    words = lambda url: set(re.findall("[a-z]+", url.split("://")[1]))
    pages = lambda rows: spark.createDataFrame([(k, u, None) for k, (u, _) in enumerate(rows)], "page_id long, url string, html string")
    train = lambda rows: spark.createDataFrame(rows, "url string, blocked boolean")

    def recall(rows, known):
        said = {r.page_id: r.verdict for r in urls.judge(pages(rows), [], train(known)).collect()}
        bad = [said[k] == "block" for k, (_, b) in enumerate(rows) if b]
        good = [said[k] == "allow" for k, (_, b) in enumerate(rows) if not b]
        return sum(bad) / len(bad), sum(good) / len(good)

    names = recall(held, [e for e in urls.EXAMPLES if e not in kept_out])
    fresh = [(f"http://{w}.test/", b) for b, lines in ((True, urls.BLOCKED), (False, urls.ALLOWED)) for line in lines for w in line.split()[::5]]
    unseen = recall(fresh, [e for e in urls.EXAMPLES if not words(e[0]) & hidden])
    print("held-out names: bad recall, good kept:", names, "unseen words:", unseen)
    assert names[0] >= 0.8 and names[1] >= 0.95
    assert unseen[1] >= 0.95


def test_cuts_do_not_change_with_the_size_of_the_pages(spark):
    """A short name of two taught words, absent from the pages, among few and among 10^11 words."""
    taught = spark.createDataFrame([("bets", 3), ("win", 3), ("other", 700)], "word string, n long")
    names = spark.createDataFrame([("betswin",), ("winbets",)], "name string")
    for n in (10, 10**6, 10**11):
        read = spark.createDataFrame([("und", n), ("the", 2 * n)], "word string, n long")
        got = {r.name: r.words for r in urls.segmented(names, urls.mixed(read, taught)).collect()}
        assert got == {"betswin": ["bets", "win"], "winbets": ["win", "bets"]}
