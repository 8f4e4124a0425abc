import datetime

import pytest
from lawloom.operators.decode import decode_resolution, decode_status, split_quarantine
from pyspark.sql import functions as F
from tree import CORE, NEEDED, SPONSOR, listed, status

STAMP = datetime.datetime(2019, 1, 3, 15, 0)
DAY = datetime.date(2019, 1, 3)
ACTIVITIES = "<activities><item><name>Referred</name><date>2019-01-03T15:00:00Z</date></item><note>skip</note></activities>"
SOURCE = "<sourceSystem><name>House</name><code>2</code></sourceSystem>"
LINKS = "<links><link><name>n</name><url>u</url></link></links>"

FULL = (
    "<originChamberCode>H</originChamberCode><updateDateIncludingText>2023-01-12T00:00:00Z</updateDateIncludingText>"
    f"<committees><item><systemCode>c1</systemCode><name>Com</name><chamber>House</chamber><type>Standing</type>"
    f"<subcommittees><item><systemCode>s1</systemCode><name>Sub</name>{ACTIVITIES}</item></subcommittees>{ACTIVITIES}</item></committees>"
    "<committeeReports><committeeReport><citation>H. Rept. 1</citation></committeeReport></committeeReports>"
    "<relatedBills><item><title>T</title><congress>117</congress><number>5</number><type>S</type>"
    "<latestAction><actionDate>2019-01-03</actionDate><text>x</text></latestAction>"
    "<relationshipDetails><item><type>Related</type><identifiedBy>CRS</identifiedBy></item></relationshipDetails></item></relatedBills>"
    f"<actions><item><actionDate>2019-01-03</actionDate><text>Introduced</text><type>IntroReferral</type><actionCode>1000</actionCode>{SOURCE}"
    "<committees><item><systemCode>c2</systemCode><name>C2</name></item></committees></item><item/></actions>"
    f"<sponsors>{SPONSOR}<item><name>Rules Committee</name></item></sponsors>"
    "<cosponsors><item><bioguideId>C1</bioguideId><fullName>Rep. C</fullName><firstName>C</firstName><lastName>D</lastName>"
    "<party>R</party><state>TX</state><sponsorshipDate>2019-01-03</sponsorshipDate><isOriginalCosponsor>True</isOriginalCosponsor></item></cosponsors>"
    "<laws><item><type>Public Law</type><number>117-9</number></item></laws>"
    f"<notes><item><text>note</text>{LINKS}</item></notes>"
    "<cboCostEstimates><item><pubDate>2019-01-03T15:00:00Z</pubDate><title>CBO</title><url>u</url></item></cboCostEstimates>"
    "<policyArea><name>Health</name></policyArea>"
    "<subjects><legislativeSubjects><item><name>Tax</name></item><item><name>Air</name></item></legislativeSubjects></subjects>"
    "<summaries><summary><versionCode>00</versionCode><actionDate>2019-01-03</actionDate><actionDesc>Introduced</actionDesc>"
    "<updateDate>2019-01-03T15:00:00Z</updateDate><text><![CDATA[<p>a &amp; b</p>]]></text></summary></summaries>"
    "<titles><item><titleType>Display</titleType><title>T</title><chamberCode>H</chamberCode></item></titles>"
    "<amendments><amendment><number>3</number><congress>117</congress><type>HAMDT</type><purpose>p</purpose>"
    "<updateDate>2019-01-03T15:00:00Z</updateDate><submittedDate>2019-01-03T15:00:00Z</submittedDate><chamber>House</chamber>"
    f"<latestAction><actionDate>2019-01-03</actionDate>{LINKS}</latestAction>"
    "<amendedBill><congress>117</congress><type>HR</type><originChamber>House</originChamber><originChamberCode>H</originChamberCode>"
    "<number>1</number><title>T</title></amendedBill>"
    "<actions><count>1</count><actions><item><actionDate>2019-01-03</actionDate><text>vote</text><recordedVotes><recordedVote>"
    "<rollNumber>7</rollNumber><chamber>House</chamber><congress>117</congress><date>2019-01-03T15:00:00Z</date>"
    "<sessionNumber>1</sessionNumber></recordedVote></recordedVotes></item></actions></actions></amendment></amendments>"
)


@pytest.fixture(scope="module")
def decoded(spark):
    def run(*docs):
        df = spark.createDataFrame(list(enumerate(docs)), "i int, bs_xml string")
        return [(r["bs"], r["violations"]) for r in decode_status(df).orderBy("i").collect()]

    return run


def test_every_entity(decoded):
    (bs, bad), = decoded(status(12, body=FULL, versions=listed("u1", "u1")))
    assert bad == []
    assert (bs["number"], bs["type"], bs["congress"], bs["version"]) == (12, "HR", 117, "3.0.0")
    com = bs["committees"][0]
    assert com["chamber"] == "House" and com["activities"][0]["date"] == STAMP
    assert com["subcommittees"][0]["activities"][0]["name"] == "Referred"
    assert bs["committee_reports"][0]["citation"] == "H. Rept. 1"
    assert bs["related_bills"][0]["latest_action"]["action_date"] == DAY
    assert bs["related_bills"][0]["relationship_details"][0]["identified_by"] == "CRS"
    assert len(bs["actions"]) == 1  # the empty element is dropped
    assert bs["actions"][0]["source_system"]["code"] == "2"
    assert bs["actions"][0]["committees"][0]["system_code"] == "c2"
    assert [s["bioguide_id"] for s in bs["sponsors"]] == ["M001"]  # a name alone is skipped
    assert bs["cosponsors"][0]["is_original_cosponsor"] is True
    assert bs["laws"][0]["number"] == "117-9"
    assert bs["notes"][0]["links"][0]["url"] == "u"
    assert bs["cbo_cost_estimates"][0]["description"] is None
    assert (bs["policy_area"], bs["subjects"]) == ("Health", ["Tax", "Air"])
    assert bs["summaries"][0]["text"] == "<p>a &amp; b</p>"
    assert bs["titles"][0]["chamber_code"] == "H"
    am = bs["amendments"][0]
    assert am["amended_bill"]["number"] == 1 and am["actions"][0]["recorded_votes"][0]["roll_number"] == 7
    assert am["latest_action"]["links"][0]["name"] == "n"
    assert bs["text_versions"][0]["url"] == "u1"
    assert bs["dublin_core"]["dc_rights"] == "rights"


def test_absent_wrappers_are_empty_lists(decoded):
    (bs, bad), = decoded(status(1))
    assert bad == []
    lists = ["committees", "actions", "sponsors", "cosponsors", "laws", "notes", "subjects", "text_versions", "amendments"]
    assert all(bs[n] == [] for n in lists)
    assert bs["policy_area"] is None


RULES = [
        (status(1, head="<billNumber>1</billNumber><billType>HR</billType>"), []),
        (status(1, head="<number>1</number><billNumber>1</billNumber><type>HR</type><billType>HR</billType>"), []),
        (status(1, head="<number>1</number><billNumber>2</billNumber><type>HR</type>"), ["number:differs"]),
        (status(1, head="<number>1</number><type>HR</type><billType>S</billType>"), ["type:differs"]),
        (status(1, head="<type>HR</type>"), ["number:missing"]),
        (status(1, head="<number>1</number>"), ["type:missing"]),
        (status(1, congress="x"), ["congress:int"]),
        (status(1, needed=NEEDED.replace("<originChamber>House</originChamber>", "")), ["origin_chamber:missing"]),
        (status(1, needed=NEEDED.split("<latestAction>")[0]), ["latest_action:missing"]),
        (status(1, body="<laws><item><type>P</type></item></laws>"), ["laws[].number:missing"]),
        (status(1, versions=listed("a", "b")), ["text_versions[].url:several"]),
        (status(1, versions="<item><type>IH</type></item><item><type/><date/></item>"), []),
        (status(1).replace(CORE, ""), [f"dublin_core.dc_{n}:missing" for n in ("format", "language", "rights", "contributor", "description")]),
        (status(1)[:300], ["malformed"]),
        (status(1).replace("</bill>", "</bil>"), ["malformed"]),
        ("", ["malformed"]),
]


def test_rules(decoded):
    found = [bad for _, bad in decoded(*[doc for doc, _ in RULES])]
    for (doc, expected), bad in zip(RULES, found):
        assert bad == expected, doc


def test_one_bad_row_leaves_the_others(spark):
    df = spark.createDataFrame([(1, status(1)), (2, "<x"), (3, status(3))], "i int, bs_xml string")
    good, bad = split_quarantine(decode_status(df))
    assert sorted(r["i"] for r in good.collect()) == [1, 3]
    assert [(r["i"], r["violations"]) for r in bad.collect()] == [(2, ["malformed"])]


def test_filter_on_record_does_not_repeat_the_parse(spark):
    df = spark.createDataFrame([(1, status(1))], "i int, bs_xml string")
    query = decode_status(df).where("bs.number > 0 and size(bs.actions) = 0").select("i", F.explode_outer("bs.sponsors"))
    assert query._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1


def test_resolution(spark):
    doc = (
        '<resolution dms-id="A" key="H" public-private="public" resolution-stage="s" resolution-type="t" star-print="no">'
        '<metadata><dublinCore xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>T</dc:title><dc:publisher>P</dc:publisher>'
        "<dc:date>2021-02-03</dc:date><dc:format>f</dc:format><dc:language>EN</dc:language><dc:rights>r</dc:rights></dublinCore></metadata>"
        "<form><distribution-code>I</distribution-code><congress>117</congress><session>1</session><legis-num>H. Res. 1</legis-num>"
        "<current-chamber>House</current-chamber><legis-type>RES</legis-type><official-title>O</official-title></form></resolution>"
    )
    broken = doc.replace(' key="H"', "").replace("2021-02-03", "soon")
    df = spark.createDataFrame([(1, doc), (2, broken)], "i int, tv_xml string")
    rows = decode_resolution(df).orderBy("i").collect()
    r = rows[0]["resolution"]
    assert rows[0]["violations"] == []
    assert (r["attrs"]["dms_id"], r["attrs"]["stage_count"], r["form"]["legis_num"]) == ("A", None, "H. Res. 1")
    assert r["dublin_core"]["dc_date"] == datetime.date(2021, 2, 3)
    assert rows[1]["violations"] == ["attrs.key:missing", "dublin_core.dc_date:date"]
