import datetime as dt
import json

from docloom.llm.emails import mails, new_bodies, new_lines

AT = dt.datetime(2021, 1, 1)


def frame(spark, rows):
    """Rows of (id, subject, sender, body)."""
    data = [(k, i, "x/" + str(i) + ".msg", json.dumps({"email_subject": s, "email_from": f, "email_body": b}), AT + dt.timedelta(hours=k)) for k, (i, s, f, b) in enumerate(rows)]
    return spark.createDataFrame(data, "load_seq long, id string, document_path string, metadata string, indexed_at timestamp")


def kept(spark, body, sender="Ann Lee", subject="s"):
    return sorted(r.line_no for r in new_lines(mails(frame(spark, [("m", subject, sender, body)]))).collect())


def test_top_reply_with_signature_and_history(spark):
    body = "Hi Bob,\r\n\r\nWe take it.\r\nSubject: to approval we take 3 units.\r\n\r\nBest regards,\r\nAnn Lee\r\nBuyer\r\n\r\nOn 3 May 2021 at 10:00, Bob <b@x.test> wrote:\r\n\r\n> Ann,\r\n> offer\r\n\r\nCONFIDENTIALITY NOTICE: only for you.\r\nDelete it."
    assert kept(spark, body) == [1, 3, 4]


def test_bottom_and_inline_reply(spark):
    assert kept(spark, "On 25 May, Bob wrote:\n> Ann,\n> offer\n\nGood morning Bob,\n\nDone.\n\n-- \nAnn Lee") == [5, 7]
    assert kept(spark, "Bob Ray wrote:\n> one\n\nMy answer to one.\n\n> two\n\nMy answer to two.\n\nCheers\nAnn") == [4, 8]


def test_unprefixed_history(spark):
    assert kept(spark, "New.\n\n-----Original Message-----\nFrom: Bob\nSent: today\n\nOld.") == [1]
    assert kept(spark, "New.\n\n*From:* Bob\n*Date:* 1 May 2021\n*Subject:* x\n\nOld.") == [1]
    assert kept(spark, "New.\n________________________________\nFrom: Ray, Bob\nSent: x\nTo: y\n\nOld.") == [1]
    assert kept(spark, "On 8 Jul 2024, at 17:57,\nBob Ray <bob.ray@x.test> wrote:\n>old\n\nNew.") == [5]
    assert kept(spark, "Amir R wrote on 28 Aug 2022:\n| old\n| old too\nNew.") == [4]


def test_what_only_looks_like_history(spark):
    body = "From the original message I only kept > 5%.\nOn Monday the vendor wrote: no change.\nBest regards to the desk, and please confirm.\nPlease read the confidentiality clause again.\n- a list point"
    assert kept(spark, body) == [1, 2, 3, 4, 5]


def test_banners_devices_and_signatures(spark):
    assert kept(spark, "[EXTERNAL] Be careful.\n\nText here.\n\nSent from my phone") == [3]
    assert kept(spark, "Text here.\n\nAnn Lee | Buyer | 01 99 00") == [1]
    assert kept(spark, "Ann,\nText for my namesake.\n\nAnn") == [1, 2]


def test_unmarked_repeats_and_closings(spark):
    old = ["A first line that is long enough to be told apart from others.", "And a second line that follows it in both of the mails, word for word."]
    rows = [("a", "RE: deal", "Bob Ray", "\n".join(old)), ("b", "deal", "Ann Lee", "I agree.\n" + "\n".join(old))]
    rows += [(f"c{k}", f"other {k}", "Cy Poe", f"Text number {k}.\n\nHave a great day everyone") for k in range(4)]
    got = {(r.id, r.line_no) for r in new_lines(mails(frame(spark, rows))).collect()}
    assert got == {("a", 1), ("a", 2), ("b", 1)} | {(f"c{k}", 1) for k in range(4)}


def test_edges(spark):
    rows = [("a", None, None, "Text."), ("a", None, None, "Text."), ("b", "s", "x", ""), ("c", "s", "x", None), (None, "s", "x", "lost"), ("d", "s", "x", "y\n" * 5_000)]
    df = frame(spark, rows)
    got = new_bodies(mails(df)).collect()
    assert {r.id: r.n_lines for r in got} == {"a": 1, "d": 5_000}
    assert new_lines(mails(df.limit(0))).count() == 0
