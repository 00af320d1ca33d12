from cases import sentence

from millrace.llm import langid

DOCS = "lang string, text string"
PAGES = "page_id long, url string, html string, language string, host string"
EN = "the house and the garden with a view of the river and the old tower "
DE = "das haus und der garten mit einem blick auf den fluss und den alten turm "


def page(i, text, url="http://x.example.com/a", said=""):
    return (i, url, f"<html{said}><head><script>das und</script></head><p>{text}</p></html>" if text is not None else None, "?", "?")


def run(spark, pages, docs=((("en", EN * 20), ("de", DE * 20), (None, "x"), ("en", None)))):
    found = langid.identify(spark.createDataFrame(pages, PAGES), spark.createDataFrame(list(docs), DOCS))
    return {r.page_id: r for r in found.collect()}


def test_evidence_is_fused(spark):
    pages = [page(k, EN, "http://en.example.org/", ' lang="en"') for k in range(30)]
    pages += [page(100 + k, DE, "http://www.haus.de/x", ' lang="de"') for k in range(30)]
    pages += [page(200, "zzz", "http://www.haus.de/y"), page(201, "zzz", "http://en.example.org/y"),
              page(202, "", "http://neu.de/", ' lang="de"'), page(203, DE, "http://en.example.org/", ' lang="en"'),
              page(204, None, None), page(205, sentence(1, 20_000), "not an address")]
    got = run(spark, pages)
    assert all(got[k].language == "en" for k in range(30)) and all(got[100 + k].language == "de" for k in range(30))
    assert got[200].language == "de" and got[201].language == "en" and got[202].language == "de"
    assert got[203].language == "de" and got[203].text_language == "de" and got[203].declared == "en"
    assert got[204].declared is None and got[204].host is None and 0 < got[204].probability <= 1
    assert len(got) == 66


def test_repeated_rows_and_empty_tables(spark):
    pages = [page(1, EN), page(1, EN), (None, None, None, None, None)]
    assert run(spark, pages)[1].language == "en"
    assert run(spark, []) == {}
    assert run(spark, pages, ())[1].language == "und"


def test_address():
    assert langid.address("https://u:p@A.B.co.uk:80/x") == ("a.b.co.uk", "co.uk", "uk")
    assert langid.address("mailto:x") == (None, None, None) and langid.address(None) == (None, None, None)


def test_plain_text():
    assert langid.plain_text("a<script>b</script><b>c</b><!-- d -->&amp;").split() == ["a", "c", "&"]
