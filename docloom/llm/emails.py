"""Only the words newly written by the sender of a mail.

Bodies are exploded into lines, which are normalised (quote marks, case, blanks). A body holds the messages of a thread, the
newest first; SQL windows over the lines of one mail find where earlier messages, signatures and notices begin. What the
newest message holds is then ranked against the thread:

* of a line that also stands in an earlier message of the thread by someone else, the first-authored occurrence stays,
  whether the earlier message is a mail of its own or is quoted in one. Messages are of one thread if they have the
  same subject and one person in common (sender or quoted correspondent); for two neighbouring lines the subject is enough;
* closing formulas and notices are learned, besides public lists: short lines that several senders put before their own name,
  and lines that stand behind the closings of several senders;
* closing lines that recur at the end of one sender's mails, taken from the last line upwards, are part of the signature.

Windows are partitioned by mail only, so a partition is never longer than one body. The rules across
mails are pre-aggregated group minima and counts instead of windows over a thread or a sender, as one
thread or sender may hold a third of all mails. Marked lines are stored once.

Defined results: null or blank bodies have no lines; a mail without an id is left out; repeated
deliveries of an id count once (the latest stands); lines are counted from 1 and cut at ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import hot_left_join, scratch_path

# Closing formulas, alone on a line.
CLOSINGS = (
    "thanks", "many thanks", "thank you", "thanks and regards", "regards", "best", "best regards", "kind regards", "warm regards",
    "with kind regards", "cheers", "sincerely", "yours sincerely", "yours faithfully", "cordially", "all the best", "saludos",
    "un saludo", "saludos cordiales", "atentamente", "cordialement", "bien cordialement", "bien à vous", "salutations",
    "mit freundlichen grüßen", "mit freundlichen gruessen", "viele grüße", "beste grüße", "freundliche grüße", "grüße", "gruß",
)
_QUOTE = r"^\s*[>|]"
_INTRO = r"(?i)^(?:(?:on|am|le|el|il)\b.{3,160}(?:wrote|schrieb|a écrit|escribió|ha scritto)\b.{0,80}:|[^,.;:]{3,60} (?:wrote|a écrit|schrieb|escribió)(?: (?:on|le|am|el) [^:]{3,40}(?::\d\d)?)?\s?:)$"
_INTRO_HALF = r"(?i)^(?:on|am|le|el) .{3,60},$"
_INTRO_TAIL = r"(?i)^[^,;:]{3,120}(?:wrote|a écrit|schrieb|escribió)\s?:$"
_FORWARD = r"(?i)^-{2,}\s*(?:original message|forwarded message|original-?nachricht|ursprüngliche nachricht|weitergeleitete nachricht|message d'origine|message transféré|mensaje original|mensaje reenviado)\s*-{2,}$"
_HEAD_FROM = r"(?i)^\*?(?:from|von|de|expéditeur)\s?:\*?\s?\S"
_HEAD_NEXT = r"(?i)^\*?(?:sent|date|to|subject|gesendet|datum|an|betreff|envoyé|à|objet|enviado|fecha|para|asunto)\s?:\*?\s"
_DEVICE = r"(?i)^(?:sent from (?:my|a|an|the) |sent via |get outlook for |von unterwegs gesendet|von meinem .{2,20} gesendet|envoyé de(?:puis)? mon |enviado desde )"
_NOTICE = r"(?i)^(?:caution\s?:|\[external\]|external (?:e-?mail|sender)|\*{3}|confidential(?:ity)?(?: notice)?\s?:|disclaimer\b|this (?:e-?mail|message)(?:,| and| is (?:confidential|intended)| may)|the (?:information|content) (?:in|of) this (?:e-?mail|message)|ce (?:courriel|message) (?:est confidentiel|et )|diese (?:nachricht|e-?mail) (?:ist vertraulich|enthält|und )|este (?:correo|mensaje) (?:es confidencial|y )|please (?:consider|think of) the environment|if you (?:are not|have received) the (?:intended|this))"
# Documented bounds. Lines shorter than this recur by chance and are no repeat of an earlier message; a formula is learned
# from so many senders; a closing line recurs in so many of a sender's mails, and in at least so large a share of them.
REPEAT_CHARS = 24
#: Two neighbouring lines of this length together need no person in common.
SURE_CHARS = 80
CLOSING_SENDERS = 3
CLOSING_CHARS = 40
CLOSING_MAILS = 3
CLOSING_SHARE = 0.5
#: From a mail's end upwards, the lines that can be closing lines.
CLOSING_LINES = 8


def normal(line: Column) -> Column:
    """A line without quote marks, in lower case, with single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, r"^[\s>|]+", "")), r"\s+", " "))


def mails(df: DataFrame) -> DataFrame:
    """One row per mail from rows with ``id, metadata`` (JSON), ``document_path, indexed_at, load_seq``."""
    kind = "struct<email_subject:string,email_from:string,email_body:string>"
    found = (
        df.where(F.col("metadata").contains("email_body") & F.lower("document_path").endswith(".msg") & F.col("id").isNotNull())
        .select("id", F.from_json("metadata", kind).alias("m"), F.struct("indexed_at", "load_seq").alias("at"))
        .where(F.trim("m.email_body") != "")
    )
    last = found.groupBy("id").agg(F.max_by("m", "at").alias("m"), F.min("at").alias("at"))
    thread = F.regexp_replace(F.lower(F.trim("m.email_subject")), r"^(?:(?:re|fw|fwd|aw|wg|tr|rv)\s?:\s*)+", "")
    return last.select("id", thread.alias("thread"), F.trim("m.email_from").alias("sender"), F.col("at.indexed_at").alias("sent"), F.col("m.email_body").alias("body"))


def _written(df: DataFrame, name: str) -> DataFrame:
    df.write.parquet(path := scratch_path(df.sparkSession, name))
    return df.sparkSession.read.parquet(path)


def _marked(mail: DataFrame) -> DataFrame:
    """Lines of each mail with flags: quoted, beginning of old mail, of a signature, of a notice; whom a line names as a writer."""
    line = (
        mail.select("id", "thread", "sender", "sent", F.posexplode(F.split("body", "\n")).alias("at", "raw"))
        .withColumn("line_no", (F.col("at") + 1).cast("long"))
        .withColumn("raw", F.rtrim(F.regexp_replace("raw", "\r$", "")))
        .withColumn("text", F.trim("raw"))
    )
    own = Window.partitionBy("id").orderBy("at")
    line = line.withColumns({f"next{k}": F.coalesce(F.lead("raw", k).over(own), F.lit("")) for k in (1, 2, 3)} | {"last1": F.coalesce(F.lag("raw", 1).over(own), F.lit(""))})
    text, following = F.col("text"), F.when(F.trim("next1") != "", F.col("next1")).otherwise(F.col("next2"))
    quoted = F.col("raw").rlike(_QUOTE)
    half = text.rlike(_INTRO_HALF) & F.col("next1").rlike(_INTRO_TAIL)
    tail = text.rlike(_INTRO_TAIL) & F.trim("last1").rlike(_INTRO_HALF)
    intro = text.rlike(_INTRO) | half | tail
    beyond = F.when(half, F.when(F.trim("next2") != "", F.col("next2")).otherwise(F.col("next3"))).otherwise(following)
    header = text.rlike(_HEAD_FROM) & (F.col("next1").rlike(_HEAD_NEXT) | F.col("next2").rlike(_HEAD_NEXT))
    rule = text.rlike(r"^_{5,}$")
    old = text.rlike(_FORWARD) | header | (intro & ~beyond.rlike(_QUOTE)) | (rule & F.col("next1").rlike(_HEAD_FROM))
    name, bare = F.lower("sender"), F.lower(text)
    named = (bare == name) | (bare == F.substring_index(name, " ", 1))
    signed = (
        F.regexp_replace(bare, r"[\s,.!]+$", "").isin(*CLOSINGS)
        | F.col("raw").rlike(r"^--\s*$")
        | text.rlike(_DEVICE)
        | rule
        | named
        | (F.startswith(bare, F.concat(name, F.lit(" "))) & F.substring(bare, F.length(name) + 1, 4).rlike(r"^ ?[|/,]"))
    )
    plain = F.regexp_replace("raw", r"^[\s>|*]+", "")
    writer = F.coalesce(
        F.nullif(F.regexp_extract(plain, rf"(?i)^(?:from|von|de|expéditeur)\s?:\*?\s?{_PERSON}", 1), F.lit("")),
        F.when(plain.rlike(_INTRO) | plain.rlike(_INTRO_TAIL), F.nullif(F.regexp_extract(plain, rf"(?:^|[,>\d] |\bat\b ){_PERSON}(?: <[^>]*>)? (?i:wrote|schrieb|a écrit|escribió|ha scritto)", 1), F.lit(""))),
    )
    # A closing formula is learned where it stands right before its sender's name.
    before_name = ~named & (F.lower(F.trim(following)) == name) | (F.lower(F.trim(following)) == F.substring_index(name, " ", 1))
    short = (F.length(text).between(2, CLOSING_CHARS)) & ~text.rlike(r"\d") & text.rlike(r"[\p{L},!]$")
    return line.select(
        "id", "thread", "sender", "sent", "line_no", "at", "text", normal(F.col("raw")).alias("norm"), (text == "").alias("blank"), (quoted | intro).alias("quoted"),
        (old & ~quoted).alias("old"), (F.coalesce(signed, F.lit(False)) & ~quoted & (text != "")).alias("signed"), (text.rlike(_NOTICE) & ~quoted).alias("notice"),
        F.lower(writer).alias("writer"), F.coalesce(before_name & short & ~quoted, F.lit(False)).alias("formula"),
    )


_PERSON = r"([\p{Lu}][\p{L}'’-]+(?:,? [\p{Lu}][\p{L}'’.-]*){1,3})"


def _ruled(mail: DataFrame) -> DataFrame:
    """The marked lines with the rule that takes them away: ``quoted``, ``old``, ``signed``, ``formula``, ``notice``; null for the rest."""
    marked = _written(_marked(mail), "marked-lines")
    bare = F.regexp_replace("norm", r"[\s,.!]+$", "")
    formulas = marked.where("formula").groupBy(bare.alias("bare")).agg(F.countDistinct("sender").alias("n")).where(F.col("n") >= CLOSING_SENDERS).select("bare", F.lit(True).alias("learned"))
    known = marked.withColumn("bare", F.when(~F.col("blank") & ~F.col("quoted") & (F.length("text") <= CLOSING_CHARS), bare))
    seen = hot_left_join(known, formulas, ["bare"], F.xxhash64("id")).withColumn("learned", F.coalesce("learned", F.lit(False)))
    own = Window.partitionBy("id").orderBy("at")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flag = lambda c: F.max(F.col(c).cast("int")).over(upto) == 1
    part = F.sum(F.when(F.col("blank") | F.col("quoted"), 1).otherwise(0)).over(upto)
    seen = seen.withColumns({"part": part, "is_old": flag("old"), "is_signed": flag("signed"), "is_closed": flag("learned")})
    first = Window.partitionBy("id", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Notices are learned too: lines that stand behind the closings of several senders.
    after = (F.col("is_signed") | F.col("is_closed")) & ~F.col("is_old") & ~F.col("quoted") & (F.length("norm") >= REPEAT_CHARS)
    seen = _written(seen, "parts")
    notices = seen.where(after).groupBy("norm").agg(F.countDistinct("sender").alias("n")).where(F.col("n") >= CLOSING_SENDERS).select("norm", F.lit(True).alias("recurs"))
    seen = hot_left_join(seen, notices, ["norm"], F.xxhash64("id")).withColumn("notice", F.col("notice") | F.coalesce("recurs", F.lit(False)))
    rule = (
        F.when(F.col("blank"), "blank").when(F.col("quoted"), "quoted").when(F.col("is_old"), "old").when(F.col("is_signed"), "signed").when(F.col("is_closed"), "formula")
        .when(F.max(F.col("notice").cast("int")).over(first) == 1, "notice")
    )
    # What a repeat is known by, as numbers: the line, and the line with each of its neighbours.
    size = lambda c: F.length(c)
    pair = lambda a, b: F.when((size(a) > 0) & (size(b) > 0) & (size(a) + size(b) >= SURE_CHARS), F.xxhash64("thread", a, b))
    norm = F.col("norm")
    seen = seen.withColumns({
        "rule": rule, "single": F.when(size(norm) >= REPEAT_CHARS, F.xxhash64("thread", norm)), "pairs": F.array_compact(F.array(pair(norm, F.lead("norm").over(own)), pair(F.lag("norm").over(own), norm))),
    })
    columns = ("id", "sender", "sent", "line_no", "text", "norm", "writer", "single", "pairs")
    return _written(seen.where("rule is null or rule <> 'blank'").select(*columns, "rule"), "ruled-lines")


def _repeats(lines: DataFrame) -> DataFrame:
    """``id, line_no`` of lines that an earlier message of the thread, by someone else, already holds."""
    name = F.xxhash64(F.lower("sender"))
    people = lines.where("writer is not null").select("id", F.xxhash64("writer").alias("person")).unionByName(lines.where("sender is not null").select("id", name.alias("person"))).distinct()
    # A quoted line belongs to a message before the mail, a new one to the mail itself.
    quoted = F.coalesce(F.col("rule").isin("quoted", "old"), F.lit(False))
    at = F.struct("sent", (~quoted).cast("int").alias("own"))
    held = lines.where(F.col("rule").isNull() | quoted).select("id", name.alias("by"), "line_no", at.alias("at"), quoted.alias("was"), "single", "pairs")
    kept = ("id", "by", "line_no", "at", "was")
    placed = held.where("single is not null").join(people, "id").select(F.xxhash64("single", "person").alias("key"), *kept)
    placed = placed.unionByName(held.select(F.explode("pairs").alias("key"), *kept))
    firsts = placed.groupBy("key").agg(F.min(F.struct("at", "id", "was", "by")).alias("first"), F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("key", "first")
    mine = hot_left_join(placed.where("not was").select("key", "id", "by", "line_no"), firsts, ["key"], F.xxhash64("id")).where("first is not null and first.id <> id")
    other = F.col("first.was") | ~F.col("first.by").eqNullSafe(F.col("by"))
    return mine.where(other).select("id", "line_no").distinct()


def _closings(lines: DataFrame) -> DataFrame:
    """``id, line_no`` of the lines that end many of their sender's mails, from the last line of a mail upwards."""
    up = Window.partitionBy("id").orderBy(F.desc("line_no"))
    tails = lines.withColumn("place", F.row_number().over(up)).where(F.col("place") <= CLOSING_LINES)
    often = tails.groupBy("sender", "norm").agg(F.countDistinct("id").alias("n")).where(F.col("n") >= CLOSING_MAILS)
    total = lines.groupBy("sender").agg(F.countDistinct("id").alias("n_mails")).where(F.col("n_mails") >= CLOSING_MAILS)
    recurrent = often.join(total, "sender").where(F.col("n") >= CLOSING_SHARE * F.col("n_mails")).select("sender", "norm", "n")
    found = hot_left_join(tails, recurrent, ["sender", "norm"], F.xxhash64("id")).withColumn("all", F.min(F.col("n").isNotNull().cast("int")).over(up))
    return found.where("all = 1").select("id", "line_no")


def ruled_lines(mail: DataFrame) -> DataFrame:
    """``id, line_no, text, rule`` of the non-blank lines; ``rule`` says what takes a line away: besides the marks, ``repeat`` and ``closing``."""
    lines = _ruled(mail)
    new = lines.where("rule is null")
    repeats = _written(_repeats(lines), "repeated-lines")
    rest = new.join(repeats, ["id", "line_no"], "left_anti")
    gone = repeats.withColumn("rule2", F.lit("repeat")).unionByName(_closings(rest).withColumn("rule2", F.lit("closing")))
    return lines.join(gone, ["id", "line_no"], "left").select("id", "line_no", "text", F.coalesce("rule", "rule2").alias("rule"))


def new_lines(mail: DataFrame) -> DataFrame:
    """``id, line_no, text`` of the lines newly written; ``mail`` as from :func:`mails`."""
    return ruled_lines(mail).where("rule is null").select("id", "line_no", "text")


def new_bodies(mail: DataFrame) -> DataFrame:
    """Each mail reduced to its new lines: ``id, new_text, n_lines`` (blank for a mail without any)."""
    lines = new_lines(mail).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("l"))
    joined = mail.select("id").join(lines, "id", "left")
    text = F.coalesce(F.array_join(F.transform("l", lambda x: x["text"]), "\n"), F.lit(""))
    return joined.select("id", text.alias("new_text"), F.greatest(F.size("l"), F.lit(0)).alias("n_lines"))


__all__ = ["mails", "new_bodies", "new_lines", "ruled_lines"]
