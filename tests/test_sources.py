"""XML dump and JSON comment sources written by the tests."""

import bz2
import json

from quarry.sources import comments as csrc
from quarry.sources import dump

DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10">
  <siteinfo>
    <sitename>Wikipedia</sitename>
    <base>https://en.wikipedia.org/wiki/Main_Page</base>
    <namespaces>
      <namespace key="0" case="first-letter" />
      <namespace key="10" case="first-letter">Template</namespace>
      <namespace key="828" case="first-letter">Module</namespace>
    </namespaces>
  </siteinfo>
  <page>
    <title>Alpha: one/two</title>
    <ns>0</ns>
    <id>1</id>
    <revision><id>11</id><contributor><username>u</username><id>999</id></contributor>
      <text xml:space="preserve">first &amp;lt;b&amp;gt; {{T|x}}</text></revision>
    <revision><id>12</id><text xml:space="preserve">second &lt;b&gt;x&lt;/b&gt; &amp;lt;i&amp;gt; {{T|x}}</text></revision>
  </page>
  <page>
    <title>Beta</title>
    <ns>0</ns>
    <id>2</id>
    <redirect title="Alpha: one/two" />
    <revision><id>21</id><text xml:space="preserve">#REDIRECT [[Alpha]]</text></revision>
  </page>
  <page>
    <title>Empty</title>
    <ns>0</ns>
    <id>3</id>
    <revision><id>31</id><text xml:space="preserve" /></revision>
  </page>
  <page>
    <title>Template:T</title>
    <ns>10</ns>
    <id>4</id>
    <revision><id>41</id><text xml:space="preserve">[{{{1}}}]</text></revision>
  </page>
  <page>
    <title>Module:M</title>
    <ns>828</ns>
    <id>5</id>
    <revision><id>51</id><text xml:space="preserve">local p = {}</text></revision>
  </page>
</mediawiki>
"""


def _write(tmp_path, name, data, compress=False):
    p = tmp_path / name
    if compress:
        p.write_bytes(bz2.compress(data.encode()))
    else:
        p.write_text(data)
    return str(p)


def test_read_pages_plain_and_bz2(spark, tmp_path):
    for path in (_write(tmp_path, "d.xml", DUMP), _write(tmp_path, "d.xml.bz2", DUMP, True)):
        rows = {r.page_id: r for r in dump.read_pages(spark, path).collect()}
        assert set(rows) == {1, 2, 3, 4, 5}
        assert rows[1].rev_id == 12 and rows[1].text == "second <b>x</b> &lt;i&gt; {{T|x}}"
        assert rows[1].title == "Alpha: one/two"
        assert rows[2].redirect_title == "Alpha: one/two"
        assert rows[3].text == ""
        assert rows[4].ns == 10 and rows[5].ns == 828


def test_all_revisions_joined(spark, tmp_path):
    path = _write(tmp_path, "d.xml", DUMP)
    r = dump.read_pages(spark, path, all_revisions=True).where("page_id = 1").first()
    assert r.text.startswith("first") and "second" in r.text


def test_siteinfo_and_namespaces(spark, tmp_path):
    path = _write(tmp_path, "d.xml", DUMP)
    info = dump.read_siteinfo(spark, path).first()
    assert info.url_base == "https://en.wikipedia.org/wiki"
    ns = {r.ns_key: r.ns_name for r in dump.read_namespaces(spark, path).collect()}
    assert ns == {0: None, 10: "Template", 828: "Module"}
    from quarry.options import Options

    o = dump.site_options(spark, path, Options())
    assert o.template_prefix == "Template:" and o.module_prefix == "Module:" and ("Module", 828) in o.known_namespaces


def test_dump_to_documents_end_to_end(spark, tmp_path):
    from quarry.options import Options
    from quarry.plans import jobs

    path = _write(tmp_path, "d.xml.bz2", DUMP, True)
    opts = dump.site_options(spark, path, Options())
    docs = {r.id: r for r in jobs.documents(dump.read_pages(spark, path), opts, raw=False).collect()}
    assert set(docs) == {"1", "3"}
    assert docs["1"].url == "https://en.wikipedia.org/wiki?curid=1"
    # Markup escaped once is markup; escaped twice it survives as text, as in the reference.
    assert docs["1"].text == "Alpha: one/two\n\nsecond x <i> [x]"


def test_comments_json_with_bad_lines(spark, tmp_path):
    lines = [json.dumps({"body": "[a](http://x.org) &gt; b", "score": 1}), "not json", json.dumps({"id": 3})]
    p1 = _write(tmp_path, "c1.json", "\n".join(lines) + "\n")
    _write(tmp_path, "c2.json.bz2", json.dumps({"body": "*z~"}) + "\n", True)
    df = csrc.read_comments(spark, str(tmp_path / "c*.json*"))
    assert df.count() == 4
    assert csrc.bad_records(df).count() == 1
    from quarry.operators.comments import comment_texts

    texts = sorted(r.text for r in comment_texts(df).collect())
    assert texts == ["a > b", "z"]
    assert p1.endswith("c1.json")


def test_html_mode_documents(spark):
    from quarry.options import Options
    from quarry.plans import jobs

    pages = spark.createDataFrame([(
        7, 0, "Page", None, 7,
        "Intro '''bold''' and ''it'' [[Target page|label]] a < b\n== Sec ==\nBody [http://e.org/x site]\n* item")],
        "page_id long, ns int, title string, redirect_title string, rev_id long, text string")
    o = Options(to_html=True, keep_lists=True, expand_templates=False, url_base="u")
    doc = jobs.documents(pages, o, raw=False).first()
    # <b>/<i> made from quotes are ignored tags and are dropped again by the cleaner, as in the reference.
    assert doc.text == ("<h1>Page</h1>\nIntro bold and it &lt;a href=\"Target%20page\"&gt;label&lt;/a&gt; a &lt; b\n"
                        "<h2>Sec</h2>\nBody &lt;a href=\"http%3A//e.org/x\"&gt;site&lt;/a&gt;\n- item")
