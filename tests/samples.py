"""Synthetic editions in the shapes of the dialects."""

MODERN = """<book filename="Alpha" title="Book of Alpha" textStructure="fluid">
<version title="Greek A" author="Ed." language="Greek">
 <divisions><division label="Chapter" delimiter=":"/><division label="Verse" delimiter=""/></divisions>
 <resources><resource name="Site"><info>about</info><URL>http://x.org</URL></resource></resources>
 <manuscripts><ms abbrev="P" language="Greek" show="yes"><name>Papyrus<sup>1</sup></name><bibliography>A <booktitle>B</booktitle></bibliography></ms><ms abbrev="Q" language="Greek" show="no"/></manuscripts>
 <text><div number="1">
  <div number="1"><unit id="1"><reading option="0" mss="P Q">alpha <w lex="be" morph="N">beta</w> gamma.</reading></unit><unit id="2" linebreak="following"><reading option="0" mss="P">delta</reading><reading option="1" mss="Q"></reading></unit></div>
  <div number="2"><unit id="3"><reading option="0" mss="P"></reading><reading option="1" mss="Q Z">omega  psi</reading></unit></div>
  <div number="2"><unit id="4"><reading option="0" mss="P Q">again</reading></unit></div>
  <div number="3"/><elipsis>...</elipsis><reading option="0" mss="P">stray</reading>
 </div></text>
</version>
<version title="Greek A" author="Ed." language="Greek">
 <divisions><division label="Verse"/></divisions><manuscripts/>
 <text/>
</version>
<version title="English" author="" language="English">
 <divisions><division label="Chapter" Delimiter=":"/><division label="Verse"/></divisions>
 <manuscripts><ms abbrev="OCP-Trans" language="English" show="yes"/></manuscripts>
 <text><div number="1">
  <div number="1"><unit id="en_1"><reading option="0" mss="OCP-Trans">one</reading></unit><unit id="en_2"><reading option="0" mss="OCP-Trans">two</reading></unit></div>
  <div number="2"><unit id="en_3"><reading option="0" mss="OCP-Trans"></reading></unit></div><div number="2"><unit id="en_4"><reading option="0" mss="OCP-Trans">four</reading></unit></div>
 </div></text>
</version>
</book>"""

LEGACY = """<book filename="Beta" title="Beta" language="Latin"><manuscripts><ms abbrev="M" language="Latin" show="yes"/></manuscripts>
<text><chapter number="1"><verse reference="1"><unit id="a"><reading option="0" mss="M">verbum unum</reading></unit></verse><verse reference="2"><unit id="b"><reading option="0" mss="M">secundum</reading></unit></verse></chapter></text></book>"""

COMPACT = """<book filename="Gamma.xml" title="Gamma"><version id="Greek" title="Text" lang="grc">
<divisions><division id="1" title="Section" type="section"/></divisions><manuscripts><manuscript id="K" name="Kodex"/></manuscripts>
<text><div number="1"><unit id="1.1"><reading option="base" mss="K">logos</reading></unit><unit id="1.2"><reading option="base" mss="K">nomos</reading></unit></div></text></version>
<version id="English" title="English Translation" lang="eng"><divisions><division id="1" title="Section" type="section"/></divisions><manuscripts><manuscript id="Eng" name="English"/></manuscripts>
<text><div number="1"><unit id="1.1"><reading option="base" mss="Eng">word</reading></unit><unit id="1.2"><reading option="base" mss="Eng">law</reading></unit></div></text></version></book>"""

MIXED = """<book filename="Delta" title="Delta"><version title="V" author="x" language="Greek">
<divisions><division label="Part" delimiter="/"/><division label="Chapter" delimiter=":"/><division label="Verse"/></divisions><manuscripts><ms abbrev="A" language="Greek" show="yes"/></manuscripts>
<text><div number="P"><div number="1"><unit id="1"><reading option="0" mss="A">shallow</reading></unit></div><div number="2"><div number="5"><unit id="2"><reading option="0" mss="A">deep</reading></unit></div></div></div></text></version></book>"""

TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0" xml:id="Beta"><teiHeader><fileDesc><publicationStmt><availability status="restricted"><licence target="http://l.org">CC BY-NC 4.0</licence></availability></publicationStmt></fileDesc></teiHeader>
<text xml:lang="lat"><body><div type="chapter" n="1"><ab type="verse" n="1.1" xml:id="Beta.1.1"><w lemma="verbum" pos="N" msd="n">verbum</w> <w lemma="unus" pos="A" msd="a">unum</w><pc>.</pc></ab><ab type="verse" n="1.2" xml:id="Beta.1.2"><w lemma="secundus" pos="A" msd="a">secundum</w></ab></div></body></text></TEI>"""


def write(folder, **named):
    for name, content in named.items():
        (folder / f"{name}.xml").write_text(content, encoding="utf-8")
    return str(folder)
