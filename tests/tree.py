"""A small hand-written source tree: one bill or text per rule."""

import os

CORE = "".join(f"<dc:{n}>{n}</dc:{n}>" for n in ("format", "language", "rights", "contributor", "description"))
NEEDED = (
    "<updateDate>2023-01-11T13:31:58Z</updateDate><originChamber>House</originChamber>"
    "<introducedDate>2019-01-03</introducedDate><congress>{congress}</congress><title>Bill {number}</title>"
    "<latestAction><actionDate>2019-02-03</actionDate><text>Referred</text></latestAction>"
)
SPONSOR = (
    "<item><bioguideId>M001</bioguideId><fullName>Rep. Poe, Ann [D-MA-2]</fullName><firstName>Ann</firstName>"
    "<lastName>Poe</lastName><party>D</party><state>MA</state><district>2</district></item>"
)


def status(number, congress=117, head=None, body="", needed=NEEDED, versions=""):
    head = f"<number>{number}</number><type>HR</type>" if head is None else head
    return (
        '<?xml version="1.0" encoding="utf-8" standalone="no"?>\n'
        '<billStatus xmlns:dc="http://purl.org/dc/elements/1.1/">\n  <version>3.0.0</version>\n  <bill>\n    '
        + head
        + needed.format(congress=congress, number=number)
        + body
        + (f"<textVersions>{versions}</textVersions>" if versions else "")
        + f"</bill><dublinCore>{CORE}</dublinCore></billStatus>\n"
    )


def listed(*urls, kind="IH", date="2019-01-03T05:00:00Z"):
    formats = "".join(f"<item><url>{u}</url></item>" for u in urls)
    return f"<item><type>{kind}</type><date>{date}</date><formats>{formats}</formats></item>"


def url(name):
    return f"https://example.org/link/{name}"


def put(root, path, body, lastmod="2024-01-01T00:00:00Z\n"):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w", encoding="utf-8") as f:
        f.write(body)
    if lastmod is not None:
        with open(full.rsplit(".", 1)[0] + "-lastmod.txt", "w", encoding="utf-8") as f:
            f.write(lastmod)


def put_status(root, number, body, congress=117, lastmod="2024-01-01T00:00:00Z\n"):
    put(root, f"data/{congress}/bills/hr/hr{number}/fdsys_billstatus.xml", body, lastmod)


def put_text(root, name, body, lastmod, folder="data/govinfo/BILLS/117/1/hr"):
    put(root, f"{folder}/{name}", body, lastmod)


def text(title, *paragraphs, meta=True):
    meta = "<metadata><dublinCore>m</dublinCore></metadata>" if meta else ""
    body = "".join(f"<section><text>{p}</text></section>" for p in paragraphs)
    return (
        '<?xml version="1.0"?>\n<!DOCTYPE bill PUBLIC "-//X//DTDs/bill.dtd//EN" "bill.dtd">\n'
        f'<bill stage="Introduced">{meta}<form><official-title>{title}</official-title></form>\n'
        f"<legis-body>{body}</legis-body> <attestation> </attestation></bill>\n"
    )


def build(root):
    """The standard tree; returns its root."""
    root = str(root)
    # hr1: two dtd versions (newest wins), one listed twice, one uslm file, one law file.
    put_status(root, 1, status(
        1,
        body=f"<sponsors>{SPONSOR}<item><name>Rules Committee</name></item></sponsors>"
        "<subjects><legislativeSubjects><item><name>Tax</name></item><item><name>Air</name></item></legislativeSubjects></subjects>"
        "<policyArea><name>Health</name></policyArea>",
        versions=listed(url("BILLS-117hr1ih.xml"), url("BILLS-117hr1ih.xml"))
        + listed(url("BILLS-117hr1eh.xml"), kind="EH", date="2019-05-01T05:00:00Z")
        + listed(url("BILLS-117hr1eh.xml"), kind="EH again", date="2019-05-01T05:00:00Z")
        + listed(url("PLAW-117publ9.xml"), kind="Law")
        + "<item><type>RH</type><formats/></item><item><type/></item>",
    ))
    put_text(root, "BILLS-117hr1ih.xml", text("First", "Old\ttext &amp; more", "second   one"), "2022-01-01T00:00:00Z")
    put_text(root, "BILLS-117hr1eh.xml", text("First", "New <em>text</em>", meta=False), "2022-06-01T00:00:00Z")
    put_text(root, "BILLS-117hr1eh.xml", "<bill><form>uslm</form></bill>", "2023-01-01T00:00:00Z",
             folder="data/govinfo/BILLS/117/1/hr/uslm")
    put_text(root, "PLAW-117publ9.xml", "<pLaw><main>law</main></pLaw>", "2023-01-01T00:00:00Z",
             folder="data/govinfo/PLAW/117/public")
    # hr2: legacy names for number and type, equal lastmod on two versions.
    put_status(root, 2, status(
        2, head="<billNumber>2</billNumber><billType>HR</billType>",
        body=f"<sponsors>{SPONSOR}</sponsors>",
        versions=listed(url("BILLS-117hr2ih.xml")) + listed(url("BILLS-117hr2eh.xml")),
    ))
    put_text(root, "BILLS-117hr2ih.xml", text("Second", "a; b"), "2022-01-01T00:00:00Z")
    put_text(root, "BILLS-117hr2eh.xml", text("Second", "c"), "2022-01-01T00:00:00Z")
    # hr3: no text at all; hr4: only a uslm file.
    put_status(root, 3, status(3))
    put_status(root, 4, status(4, versions=listed(url("BILLS-117hr4ih.xml"))))
    put_text(root, "BILLS-117hr4ih.xml", "<bill><form>x</form></bill>", "2022-01-01T00:00:00Z",
             folder="data/govinfo/BILLS/117/1/hr/uslm")
    # Congress 118: five bills for the split; hr12 has blank text.
    for n in range(10, 15):
        put_status(root, n, status(n, congress=118, body=f"<sponsors>{SPONSOR}</sponsors>",
                                   versions=listed(url(f"BILLS-118hr{n}ih.xml"))), congress=118)
        body = "<bill><form> </form></bill>" if n == 12 else text(f"Held {n}", f"body {n}")
        put_text(root, f"BILLS-118hr{n}ih.xml", body, "2023-01-01T00:00:00Z", folder="data/govinfo/BILLS/118/1/hr")
    # Rows that must be quarantined.
    put_status(root, 5, status(5, head="<number>5</number><billNumber>6</billNumber><type>HR</type>"))
    put_status(root, 6, status(6)[:400])
    put_status(root, 7, status(7, needed=NEEDED.replace("<introducedDate>2019-01-03</introducedDate>", "")))
    put_status(root, 8, status(8), lastmod=None)
    put_status(root, 9, status(9, versions=listed(url("a.xml"), url("b.xml"))))
    put(root, "data/odd/fdsys_billstatus.xml", status(99))
    put_text(root, "OTHER-117hr1.xml", "<x/>", "2022-01-01T00:00:00Z")
    put_text(root, "BILLS-117hr77ih.xml", "<html><body>x</body></html>", "2022-01-01T00:00:00Z")
    return root
