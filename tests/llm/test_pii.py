import pytest

from docloom.llm.pii import find, found, known_names, redact, redacted

CASES = [
    ("Send it to a.b+c@x.example by Friday", [("email", "a.b+c@x.example")]),
    ("write x (at) corp.y.test or ann_l [at] y [dot] test or k @ y.test", [("email", "x (at) corp.y.test"), ("email", "ann_l [at] y [dot] test"), ("email", "k @ y.test")]),
    ("mailto:z@y.test?subject=a", [("email", "z@y.test")]),
    ("Post in the @desk channel", []),
    ("Call +1 (206) 555-0182 x96, (713) 555-0198 or 1-312-555-0120 ext. 8", [("phone", "+1 (206) 555-0182"), ("phone", "(713) 555-0198"), ("phone", "1-312-555-0120")]),
    ("Mobile:3125550177 (evenings), 020 7946 0126, +49 (0)30 23125 419, 01 99 00 63 77", [("phone", "3125550177"), ("phone", "020 7946 0126"), ("phone", "+49 (0)30 23125 419"), ("phone", "01 99 00 63 77")]),
    ("(020 7946 0502) rang", [("phone", "020 7946 0502")]),
    ("Order no. 714-890-2890, SKU 996-51-6013, Ticket #652805879, 0.5900001234, 24 7 365, 2025 12 31", []),
    ("SSN on file is 906910117, tax ID 96 994 458 614; NI number QQ 20 39 36 B", [("national_id", "906910117"), ("national_id", "96 994 458 614"), ("national_id", "QQ 20 39 36 B")]),
    ("passport no. Z53499472 and driver's licence A877-6801-9260", [("national_id", "Z53499472"), ("national_id", "A877-6801-9260")]),
    ("the perpetual licence costs 12345 and the passport office", []),
    ("at 7217 Wexley Park Avenue; P.O. Box 12, Port; Ahornweg 22, 33783 Neu; 31 bis rue des Tanneurs; Calle del Faro 54, 5º A", [("address", "7217 Wexley Park Avenue"), ("address", "P.O. Box 12"), ("address", "Ahornweg 22, 33783 Neu"), ("address", "31 bis rue des Tanneurs"), ("address", "Calle del Faro 54, 5º A")]),
    ("the 4 Street Fleet option, 6 more ways to place", []),
    ("Spoke with MARTA GRUNOWAY about it. Per Grunmoor, Ulla's note. Mrs Quillwick from the vendor side asked", [("name", "MARTA GRUNOWAY"), ("name", "Grunmoor, Ulla"), ("name", "Quillwick")]),
    ("The buyer, peter heskberg, can be reached. Escalation was agreed between Dr. Poe and I. Wexmoor.", [("name", "peter heskberg"), ("name", "Poe"), ("name", "I. Wexmoor")]),
    ("The controller (formerly K. Tav) left; mail now goes", [("name", "K. Tav")]),
    ("Marlow Ridge and Ellis Harbour are product lines. <<PERSON>> asked <<CLIENT: Regional Bank>>", []),
    ("", []), (None, []),
]


# Invented names in sentences that stand in no test table.
PERSONS = (
    "Spoke with *Bartholomew Quill* about the offer. | Please ask *Thorsten Grunmoor* for it. | Contact *Aisha Rahman* before Friday. | Yesterday *Kwabena Osei-Tutu* signed the form. | "
    "Dear *Hyejin Parkova*, | The manager, *Siobhan O'Rourke*, agreed. | Signed: *Oluwaseun Adeyemi*, buyer | Meeting with *Zbigniew Kowalczyk* and the team | "
    "Mail from *Anneliese Brandstetter* (a@b.test) came | Call Dr. *Wojciech Nowak* now | Per *Tamsin Hargreave*'s mail we pay | Attention: *Padraig Mulcahy*, 12 Hill Road | "
    "Mrs. *Haverstock* called | *Xiulan Zhangwei* <x@y.test> replied | Refer to *Gwendolyn Ashdowne* for terms | Laut *Friedrich Oberhauser* gilt das | "
    "Selon *Maëlle Kerguelen*, le prix | Vorschlag von *Lieselotte Winterhalter* liegt vor | The form was approved by *Eustace Pemberton*. | *L. Montague-Smythe* wrote again | "
    "Cheers, *Tobias Lindqvist* | *Nguyen, Thi Hoa* signed it | on behalf of *Marisol Villanueva* | *ODALYS FERNSBY* (206-555-0182) holds it | we told *Casimir van Houtenhove* so"
).split(" | ")
OTHERS = (
    "Spoke with Hexgard Networks about | Contact Marlow Ridge for | from Dublin Hub | The Buyer asked for it | quote from Old Tannery | Visit with Acme Global Solutions | met Deal Desk today | "
    "from Frankfurt Flughafen | Switching to Database Option | Per Section Four | to New York by Monday | with Frame Agreement | the guarantor signed | call Windows Server | from the West Campus"
).split(" | ")


# A second set, written after the rules and never used to change them: its figures are what to expect of other text.
UNSEEN = (
    "Minutes taken by *Rosamund Thistlewood* | The site manager is *Okonkwo Chidubem* | *Svetlana Kuznetsova* phoned twice | Reach *Emil Jankovic* after lunch | Thanks to *Ottoline Bridgerton* for the tip | "
    "*Karen White* approved the change | Kind regards, *Lorcan Gallagher* | My colleague *Ayumi Nakagawa* knows more | The tenant, *Percival Lockwood*, moved out | Herr *Zimmerbauer* ruft an | "
    "Vertreten durch *Hannelore Kirchgessner* | D'après *Gaëtan Lemercier*, non | Hablé con *Remedios Altamirano* ayer | Approver: *Dashiell Whitcombe* | On *Nkechi Adichie*'s desk | "
    "Call *Thomas Green* (212-555-0143) | *Vasquez, Inmaculada* replied | Owner *Clementine Ashgrove* signed off | the badge of *Fenella Drummond* expired | *D. Szymborska* asked for it | "
    "I gave *Isolde Marchetti* the file | hired *Ransome Eversleigh* in May"
).split(" | ")
UNSEEN_OTHERS = (
    "Meeting in Kuala Lumpur | Hosted by Amazon Redshift | Review from Quality Assurance | Travel to Palo Alto | Ask the Help Desk | Powered by Snowflake Horizon | for the Annual Review | Data Retention Policy applies | "
    "with Nordwind Logistik | Approved Vendor List was sent | from Gdansk Terminal | per Purchase Order | Adobe Acrobat is needed | the Northern Depot asked | via Kafka Connect"
).split(" | ")


def _figures(persons, others):
    """Names found whole, names there are, other spans called names, and sentences without a name that were given one."""
    found = wrong = 0
    for said in persons:
        want = said.split("*")[1]
        got = [said.replace("*", "")[b:e] for k, b, e in find(said.replace("*", "")) if k == "name"]
        found += want in got
        wrong += len(got) - (want in got)
    return found, len(persons), wrong, sum(any(k == "name" for k, _, _ in find(x)) for x in others)


def test_names_by_shape_and_cue():
    """Sentences that the rules were made with: a second given name behind a comma and a place are wrong."""
    found, n, wrong, false = _figures(PERSONS, OTHERS)
    assert found >= 0.9 * n and wrong <= 1 and false <= 1


def test_unseen_names():
    """Measured once: 14 of 22 names, none in part, and 2 of 15 other sentences wrong. A floor, not an aim that was reached."""
    found, n, wrong, false = _figures(UNSEEN, UNSEEN_OTHERS)
    assert (n, len(UNSEEN_OTHERS)) == (22, 15) and found >= 14 and wrong == 0 and false <= 2


def test_given_names_are_learned(spark):
    rows = [("Zorvanka Abelmoor",), ("zorvanka Brandlow",), ("Lone Wolfram",), (None,), ("",), ("one",), ("Zorvanka Abelmoor",)]
    given = known_names(spark.createDataFrame(rows, "n string"), ["n"])
    assert "zorvanka" in given and "lone" not in given
    text = "the clause Zorvanka Pellworth drafted"
    assert find(text) == [] and [text[b:e] for _, b, e in find(text, given)] == ["Zorvanka Pellworth"]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_find(text, want):
    assert [(k, text[b:e]) for k, b, e in find(text)] == want


def test_redact_keeps_the_rest():
    assert redact("Ask Ann Lee (a@b.test) or <<EMAIL>>.") == "Ask <<PERSON>> (<<EMAIL>>) or <<EMAIL>>."
    assert redact(None) is None and redact("") == ""


def test_positions_count_code_points():
    text = "😀é " + "İ" * 3 + " Spoke with Ann Lee."
    assert [text[b:e] for _, b, e in find(text)] == ["Ann Lee"]


def test_very_long_text_is_whole():
    text = "a@b.test, +1 206 555 0182 and words. " * 20_000
    assert len(find(text)) == 40_000


def test_rows(spark):
    df = spark.createDataFrame([(1, "a@b.test", None), (1, "a@b.test", ""), (2, None, "none"), (None, "c@d.test", "x")], "id int, field string, kind string")
    got = sorted((r.field, r.record_id or "", r.kind, r.start_pos) for r in found(df, "id", ["field", "kind"]).collect())
    assert got == [("field", "", "email", 0), ("field", "1", "email", 0), ("field", "1", "email", 0)]
    assert redacted(df, "id", ["field"]).count() == 3 and found(df.limit(0), "id", ["field"]).count() == 0
