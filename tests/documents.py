"""Hand-written documents that exercise every branch of the XML route."""

from __future__ import annotations

import json


def elsevier(doi: str = "10.1000/One", extra: str = "") -> str:
    return f"""<?xml version="1.0"?>
<full-text-retrieval-response xmlns="http://x/" xmlns:ce="http://ce/">
<coredata><doi>{doi}</doi><title>A review  of solvents</title><creator>Ann B</creator><creator>Carl D</creator>
<publicationName>J. Test</publicationName><volume>7</volume><pageRange></pageRange><articleNumber>12</articleNumber><coverDate>2021-05-01</coverDate></coredata>
<body><ce:sections>
<ce:section id="s1"><ce:section-title>Density</ce:section-title>
 <para>ChCl:Urea (1:2, 25 °C) has a density of 1.25 g/cm3 [1]. Tetraethylammonium bromide (TEAB) is used. Values −11.06 and 1.20 occur [2,3].</para></ce:section>
<ce:section id="s2"><ce:section-title>Outer</ce:section-title><ce:section id="s3"><ce:section-title>Inner</ce:section-title><para>Leaf text.</para></ce:section></ce:section>
</ce:sections></body>
<floats>
<ce:table id="t1"><label>Table 1</label><caption>Solvents</caption><legend>a at 30 °C; d at 60 °C; i weight ratio; us unstable</legend>
<tgroup cols="5"><colspec colname="c1"/><colspec colname="c2"/><colspec colname="c3"/><colspec colname="c4"/><colspec colname="c5"/>
<thead><row><entry morerows="1">HBA</entry><entry morerows="1">HBD</entry><entry morerows="1">Ratio</entry><entry>Density</entry><entry morerows="1">Ref</entry></row>
<row><entry>(g/cm3)</entry></row></thead>
<tbody>
<row><entry>Choline chloride</entry><entry>Urea</entry><entry>1:2</entry><entry>1.25</entry><entry>[1]</entry></row>
<row><entry>Choline<break/>chloride</entry><entry>Caffeic acid/Ethylene glycol</entry><entry>1:1:1</entry><entry>d1.267</entry><entry>[1,2–3]</entry></row>
<row><entry>Choline chloride</entry><entry>D/L-Proline</entry><entry>i6:4</entry><entry>0.688<sup>a</sup></entry><entry>2</entry></row>
<row><entry>[Br<sup>-</sup>] salt</entry><entry>Urea</entry><entry>us2:1</entry><entry>–</entry><entry>9</entry></row>
<row><entry>Choline chloride</entry><entry>Urea</entry><entry>C-</entry><entry>DT</entry><entry></entry></row>
<row><entry>HBA</entry><entry>HBD</entry><entry>Ratio</entry><entry>Density</entry><entry>Ref</entry></row>
<row><entry></entry><entry></entry><entry></entry><entry></entry><entry></entry></row>
<row><entry>Ragged</entry><entry>row</entry></row>
<row><entry>Choline chloride</entry><entry>Glycerol</entry><entry>1:2</entry><entry>9.9</entry><entry>3</entry></row>
</tbody></tgroup></ce:table>
<ce:table id="t2"><label>Table 2</label><caption>Other</caption><tgroup><tbody><row><entry>x</entry></row></tbody></tgroup></ce:table>
<ce:figure id="f1"><label>Fig. 1</label><caption>Densities [1, 2–3] and [3]</caption><link locator="g1" xlink:href="img.png" xmlns:xlink="http://l/"/></ce:figure>
</floats>
<bibliography>
<bib-reference><label>[1]</label><author><given-name>A.</given-name><surname>Smith</surname></author><maintitle>Density of solvents</maintitle><maintitle>J. Chem.</maintitle><date>2001</date></bib-reference>
<bib-reference><label>[2]</label><author><surname>Jones</surname></author><maintitle>Old title &amp; more</maintitle><maintitle>K</maintitle></bib-reference>
<bib-reference><label>[2]</label><maintitle>New title</maintitle></bib-reference>
<bib-reference><label>[3]</label><maintitle>Third work</maintitle></bib-reference>
<bib-reference><label>[x]</label><maintitle>Skipped</maintitle></bib-reference>
</bibliography>{extra}
</full-text-retrieval-response>"""


JATS = """<article><front><journal-meta><journal-title>Open J</journal-title></journal-meta><article-meta><article-id pub-id-type="doi">10.1000/jats</article-id>
<title-group><article-title>Jats paper</article-title></title-group><contrib-group><contrib><name><surname>Roe</surname><given-names>R.</given-names></name></contrib></contrib-group>
<pub-date><year>2020</year></pub-date><volume>3</volume><fpage>1</fpage><lpage>9</lpage></article-meta></front>
<body><sec id="a"><title>Viscosity</title><p>Text.</p></sec><sec id="b"><title>T</title><table-wrap id="w1"><label>Table 1</label><caption>Cap</caption><table><thead><tr><th colspan="2">H</th></tr></thead>
<tbody><tr><td rowspan="2">a</td><td>1</td></tr><tr><td>2</td></tr></tbody></table></table-wrap></sec></body>
<back><ref-list><ref><label>1.</label><element-citation><name><surname>Doe</surname><given-names>J</given-names></name><article-title>Ref title</article-title><source>S</source><year>1999</year></element-citation></ref></ref-list></back></article>"""

PROFILE = {
    "relevant": True, "record_type": "des_properties", "reason": "", "header_row_count": 2,
    "columns": [
        {"index": 0, "header": "HBA", "role": "component", "property": None, "unit_as_written": None, "component_role": "HBA", "context_field": None, "multi_valued": False},
        {"index": 1, "header": "HBD", "role": "component", "property": None, "unit_as_written": None, "component_role": "HBD", "context_field": None, "multi_valued": False},
        {"index": 2, "header": "Ratio", "role": "ratio", "property": None, "unit_as_written": None, "component_role": None, "context_field": None, "multi_valued": False},
        {"index": 3, "header": "Density (g/cm3)", "role": "property", "property": "Density", "unit_as_written": "(g/cm3)", "component_role": None, "context_field": None, "multi_valued": False},
        {"index": 4, "header": "Ref", "role": "reference", "property": None, "unit_as_written": None, "component_role": None, "context_field": None, "multi_valued": True},
    ],
    "footnote_markers": [
        {"marker": "a", "meaning": "temperature", "temperature_C": 30.0, "note": None}, {"marker": "d", "meaning": "temperature", "temperature_C": 60.0, "note": None},
        {"marker": "i", "meaning": "ratio_basis", "temperature_C": None, "note": None}, {"marker": "us", "meaning": "stability", "temperature_C": None, "note": None},
    ],
    "missing_value_tokens": ["n.r."], "default_temperature_C": None,
}


def prose_response(*changes: dict) -> str:
    item = {"components": ["Choline chloride", "Urea"], "molar_ratio": "1:2", "property": "Density", "value": 1.25, "unit": "g/cm3", "temperature_C": 25.0, "ref_numbers": "1", "source_text": "ChCl:Urea (1:2, 25 °C) has a density of 1.25 g/cm3 [1]"}
    return json.dumps({"measurements": [item | c for c in changes or ({},)]})
