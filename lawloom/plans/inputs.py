"""Bill-shaped inputs made by Spark from the given tables, so the same operators run on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lawloom.functions.keys import dashed


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table for work that is heavy per row."""
    return table(spark, folder, name).repartition(spark.sparkContext.defaultParallelism)


def spread(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table over all cores: a large one is by its scan and is not moved, a small one is dealt out."""
    rows = table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def _escaped(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def lines(text: Column) -> Column:
    """Lines of a text that are not blank."""
    return F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")


def _tagged(tag: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))


def _listed(items: Column) -> Column:
    return F.array_join(items, "")


def order_bills(orders: DataFrame) -> DataFrame:
    """Orders as bills: each lists versions 1 to 7, the sixth without URL."""
    key = F.col("o_orderkey").cast("string")

    def version(n: Column) -> Column:
        url = F.concat(F.lit("https://example.org/"), key, F.lit("/O-"), key, F.lit("-"), n.cast("string"), F.lit(".xml"))
        return F.struct(
            F.concat(F.lit("v"), n.cast("string")).alias("type"),
            F.col("o_orderdate").alias("date"),
            F.when(n != 6, url).alias("url"),
        )

    return orders.select(
        dashed(F.lit("o"), key).alias("legis_id"),
        F.year("o_orderdate").alias("congress_num"),
        F.col("o_orderpriority").alias("legis_type"),
        F.col("o_orderkey").alias("legis_num"),
        F.transform(F.sequence(F.lit(1), F.lit(7)), version).alias("text_versions"),
    )


def lineitem_texts(lineitem: DataFrame, *more: str | Column) -> DataFrame:
    """Line items as text versions: returned ones belong to another (law) id, open ones are uslm. `more` columns go along."""
    key = F.col("l_orderkey").cast("string")
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return lineitem.select(
        dashed(key, F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), price).alias("tv_id"),
        dashed(F.when(F.col("l_returnflag") == "R", "p").otherwise("o"), key).alias("legis_id"),
        F.concat(F.lit("O-"), key, F.lit("-"), F.col("l_linenumber").cast("string"), F.lit(".xml")).alias("file_name"),
        F.col("l_shipdate").alias("lastmod"),
        F.when(F.col("l_linestatus") == "O", "uslm").otherwise("dtd").alias("xml_type"),
        F.when(F.col("l_returnflag") == "N", F.lit(" \n"))
        .otherwise(
            F.concat(F.lit(" part "), F.col("l_partkey").cast("string"), F.lit(" of "), F.col("l_suppkey").cast("string"), F.lit("\n"))
        )
        .alias("tv_txt"),
        F.lit("<bill/>").alias("tv_xml"),
        *more,
    )


def status_documents(documents: DataFrame) -> DataFrame:
    """One status document per text: its lines are the actions, its words' heads the subjects."""
    number = F.col("doc_id").cast("string")
    action = F.transform(
        lines(F.col("text")),
        lambda x: _tagged("item", F.concat(F.lit("<actionDate>2024-01-01</actionDate>"), _tagged("text", _escaped(x)))),
    )
    version = F.concat(
        F.lit("<item><type>IH</type><date>2024-01-01T05:00:00Z</date><formats><item><url>https://example.org/"),
        number,
        F.lit(".xml</url></item></formats></item><item><type/></item>"),
    )
    body = F.concat(
        _tagged("number", number),
        _tagged("type", F.col("lang")),
        F.lit("<updateDate>2024-01-02T03:04:05Z</updateDate><originChamber>House</originChamber>"),
        F.lit("<introducedDate>2024-01-01</introducedDate><congress>118</congress>"),
        _tagged("title", _escaped(F.col("source"))),
        _tagged("actions", _listed(action)),
        _tagged("textVersions", version),
        F.lit("<latestAction><actionDate>2024-01-03</actionDate><text>last</text></latestAction>"),
    )
    core = "".join(
        f"<dc:{n}>{n}</dc:{n}>" for n in ("format", "language", "rights", "contributor", "description")
    )
    return documents.select(
        "doc_id",
        F.concat(
            F.lit('<?xml version="1.0" encoding="utf-8"?>\n<billStatus xmlns:dc="http://purl.org/dc/elements/1.1/">'),
            F.lit("<version>3.0.0</version>"),
            _tagged("bill", body),
            F.lit(f"<dublinCore>{core}</dublinCore></billStatus>"),
        ).alias("bs_xml"),
    )


def text_documents(documents: DataFrame) -> DataFrame:
    """One text document per text: metadata for English only, a form, a body with a section per line."""
    sections = F.transform(lines(F.col("text")), lambda x: _tagged("section", _tagged("text", _escaped(x))))
    return documents.select(
        "doc_id",
        F.concat(
            F.lit('<!DOCTYPE bill SYSTEM "bill.dtd">\n<bill stage="1">'),
            F.when(F.col("lang") == "en", "<metadata><dc>m</dc></metadata>").otherwise(""),
            F.lit("<form><congress>118</congress>"),
            _tagged("session", _escaped(F.col("source"))),
            F.lit("</form>\n<empty/><!-- note --><legis-body>"),
            _listed(sections),
            F.lit("</legis-body></bill>"),
        ).alias("tv_xml"),
    )


def turn_bills(conversations: DataFrame) -> DataFrame:
    """Turns as bills whose versions are the lines of their text; a turn without text has none."""
    key = dashed(F.col("conv_id"), F.col("turn"))

    def version(x: Column, i: Column) -> Column:
        return F.struct(
            F.concat(key, F.lit("-"), i.cast("string")).alias("tv_id"),
            F.lit("is").alias("legis_version"),
            F.lit("bills").alias("legis_class"),
            F.struct(F.concat(F.lit("https://example.org/"), i.cast("string")).alias("url"), F.lit("2024-01-01").alias("date")).alias("bs_tv"),
            x.alias("tv_txt"),
        )

    return conversations.select(
        key.alias("legis_id"),
        F.col("conv_id").alias("congress_num"),
        F.col("role").alias("legis_type"),
        F.col("turn").alias("legis_num"),
        F.transform(lines(F.col("text")), version).alias("tvs"),
    )


def customer_bills(customer: DataFrame) -> DataFrame:
    """Customers as bills with sponsor lists; customers in debt have no sponsor."""
    key = F.col("c_custkey").cast("string")
    person = F.struct(
        F.concat(F.lit("M"), key).alias("bioguide_id"),
        F.concat(F.col("c_name"), F.lit(" ["), F.substring("c_mktsegment", 1, 1), F.lit("-"), F.col("c_nationkey").cast("string"), F.lit("-1]")).alias("full_name"),
        F.substring("c_mktsegment", 1, 1).alias("party"),
        F.when(F.col("c_nationkey") > 4, F.col("c_nationkey").cast("string")).alias("state"),
    )
    words = F.split("c_name", "0")
    co = F.transform(
        words,
        lambda w: F.struct(w.alias("bioguide_id"), F.upper(w).alias("full_name"), F.length(w).cast("string").alias("party"), F.nullif(w, F.lit("")).alias("state")),
    )
    return customer.select(
        F.col("c_custkey"),
        F.struct(
            F.filter(F.array(person), lambda _: F.col("c_acctbal") >= 0).alias("sponsors"),
            co.alias("cosponsors"),
            F.lit("2024-01-01").cast("date").alias("introduced_date"),
            F.when(F.col("c_nationkey") != 7, F.col("c_mktsegment")).alias("policy_area"),
            F.col("c_name").alias("title"),
            F.array(F.col("c_mktsegment"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("subjects"),
        ).alias("bs"),
    )


def vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select("vec_id", F.col("embedding").alias("vec"), "label")


def label_centres(embeddings: DataFrame) -> DataFrame:
    """Mean vector per label: a small batch of queries that depends on every row."""
    cells = embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    packed = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("cells"))
    return packed.select(
        F.col("label").cast("bigint").alias("query_id"), F.transform("cells", lambda c: c["m"]).alias("vec")
    )


#: A status document with one of every nested record; @K is the customer's key, @S its segment, @N its nation.
FULL_STATUS = (
    '<?xml version="1.0" encoding="utf-8"?>\n<billStatus xmlns:dc="http://purl.org/dc/elements/1.1/"><version>3.0.0</version><bill>'
    "<number>@K</number><type>HR</type><updateDate>2024-01-02T03:04:05Z</updateDate><originChamber>House</originChamber>"
    "<introducedDate>2024-01-01</introducedDate><congress>118</congress><title>@S</title>"
    "<committees><item><systemCode>hs@K</systemCode><name>Committee @S</name><chamber>House</chamber><type>Standing</type>"
    "<subcommittees><item><systemCode>ss@K</systemCode><name>Sub @N</name><activities><item><name>Referred</name>"
    "<date>2024-01-01T05:00:00Z</date></item></activities></item></subcommittees>"
    "<activities><item><name>Markup</name><date>2024-01-02T05:00:00Z</date></item></activities></item></committees>"
    "<committeeReports><committeeReport><citation>Report @K</citation></committeeReport></committeeReports>"
    "<relatedBills><item><title>Like @S</title><congress>117</congress><number>@K</number><type>S</type>"
    "<latestAction><actionDate>2024-01-03</actionDate><text>Read @N</text></latestAction><relationshipDetails><item>"
    "<type>Identical</type><identifiedBy>CRS @N</identifiedBy></item></relationshipDetails></item></relatedBills>"
    "<actions><item><actionDate>2024-01-04</actionDate><text>Sent @K</text><type>Floor</type><actionCode>A@N</actionCode>"
    "<sourceSystem><code>9</code><name>House @S</name></sourceSystem></item></actions>"
    "<sponsors><item><bioguideId>M@K</bioguideId><fullName>Rep. @S</fullName><firstName>Ann</firstName><lastName>@S</lastName>"
    "<party>D</party><state>S@N</state><identifiers><bioguideId>M@K</bioguideId><lisID>@N</lisID><gpoId>7</gpoId></identifiers>"
    "<district>@N</district><isByRequest>N</isByRequest></item></sponsors>"
    "<cosponsors><item><bioguideId>C@K</bioguideId><fullName>Rep. Co @S</fullName><firstName>Co</firstName><lastName>@S</lastName>"
    "<party>R</party><state>T@N</state><middleName>Q</middleName><sponsorshipDate>2024-01-05</sponsorshipDate>"
    "<isOriginalCosponsor>True</isOriginalCosponsor></item></cosponsors>"
    "<laws><item><type>Public Law</type><number>118-@K</number></item></laws>"
    "<notes><item><text>Note @S</text><links><link><name>n@N</name><url>https://example.org/@K</url></link></links></item></notes>"
    "<cboCostEstimates><item><pubDate>2024-01-06T05:00:00Z</pubDate><title>Cost @S</title><url>https://example.org/c/@K</url>"
    "<description>d@N</description></item></cboCostEstimates>"
    "<policyArea><name>@S</name></policyArea><subjects><legislativeSubjects><item><name>@S</name></item><item><name>n@N</name></item>"
    "</legislativeSubjects></subjects>"
    "<summaries><summary><versionCode>00</versionCode><actionDate>2024-01-07</actionDate><actionDesc>As @S</actionDesc>"
    "<updateDate>2024-01-08T05:00:00Z</updateDate><text>Sum @K</text></summary></summaries>"
    "<titles><item><titleType>Short</titleType><title>T @S</title><chamberCode>H</chamberCode><chamberName>House</chamberName></item></titles>"
    "<amendments><amendment><number>@K</number><congress>118</congress><type>HAMDT</type><description>am @N</description>"
    "<updateDate>2024-01-09T05:00:00Z</updateDate><submittedDate>2024-01-10T05:00:00Z</submittedDate><chamber>House</chamber>"
    "<amendedBill><congress>118</congress><type>HR</type><originChamber>House</originChamber><originChamberCode>H</originChamberCode>"
    "<number>@K</number><title>@S</title></amendedBill>"
    "<links><link><name>l@N</name><url>https://example.org/a/@K</url></link></links>"
    "<actions><count>1</count><actions><item><actionDate>2024-01-11</actionDate><text>Agreed @N</text><recordedVotes><recordedVote>"
    "<rollNumber>@N</rollNumber><chamber>House</chamber><congress>118</congress><date>2024-01-12T05:00:00Z</date>"
    "<sessionNumber>2</sessionNumber><url>https://example.org/v/@K</url></recordedVote></recordedVotes></item></actions></actions>"
    "</amendment></amendments>"
    "<latestAction><actionDate>2024-01-13</actionDate><text>last @S</text></latestAction></bill>"
    "<dublinCore><dc:format>f</dc:format><dc:language>l@N</dc:language><dc:rights>r</dc:rights><dc:contributor>c@K</dc:contributor>"
    "<dc:description>d</dc:description></dublinCore></billStatus>"
)


def full_status_documents(customer: DataFrame) -> DataFrame:
    """One status document per customer, with every kind of nested record."""
    text = F.lit(FULL_STATUS)
    for mark, value in (("@K", "c_custkey"), ("@S", "c_mktsegment"), ("@N", "c_nationkey")):
        text = F.replace(text, F.lit(mark), F.col(value).cast("string"))
    return customer.select("c_custkey", text.alias("bs_xml"))
