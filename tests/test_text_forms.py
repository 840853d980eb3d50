"""Forms as projections, and files that nothing was read from."""

import pytest
import samples
from stemmata.functions import text
from stemmata.sources import tei, xml


def test_forms(spark):
    df = spark.createDataFrame([("a", None, 3)], "prefix string, word string, n int")
    forms = {"{prefix}{word}": "a", "{prefix}-{word}-{n}": "a--3", "x{{{n}}}": "x{3}", "": "", "plain": "plain", "{w}": "a"}
    for form, want in forms.items():
        assert df.select(text.template(form, {"w": "prefix"})).first()[0] == want


def test_files_without_a_work(spark):
    docs = spark.createDataFrame([("a.xml", b" \n\t"), ("b.xml", b"<book/>"), ("c.xml", b""), ("d.xml", b"<x/>")], "path string, content binary")
    works = spark.createDataFrame([("b.xml",), ("b.xml",)], "file string")
    assert [r.path for r in xml.unparsed(docs, works).collect()] == ["d.xml"]


def test_the_language_of_an_overlay():
    data = samples.TEI.encode()
    assert tei.words(data, "Beta") == tei.words(data, "Beta", language="lat")
    for bad, language in ((data, "grc"), (data.replace(b' xml:lang="lat"', b""), None), (data.replace(b'xml:lang="lat"', b'xml:lang=" "'), None)):
        with pytest.raises(ValueError, match="language"):
            tei.words(bad, "Beta", language=language)
