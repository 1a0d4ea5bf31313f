"""Personal data in free text: found by anchor expansion, replaced by typed placeholders.

One Aho-Corasick pass over a text finds anchors: at-signs and their spellings, schemes, identifier cues,
street words, titles, given names, and words that stand before or after persons. Each anchor is handed to a small
deterministic parser that expands it to its boundaries and validates it. Runs of digits are anchors of
telephone numbers. Where candidates overlap, the kind decides (email, national_id, address, phone, name),
then the longer one.

A name is known by its shape (given name or initial and surname, or surname, comma and given name) and by what stands
beside it: a title, a word that goes with persons (spoke with, attention, signed by; asked, signed, left), or an email
address, telephone or identity number. Its surname must be no common word, by a public tokenizer's vocabulary,
and none of its words may be one of a company. Given names that are known make names without any cue: a public
list of frequent ones, and those that ``known_names`` learns from columns that hold names.

Defined results: null and empty texts hold nothing and stay as they are; placeholders that already stand
in a text are left alone; repeated rows give repeated results (queries take them once).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "national_id", "address", "phone", "name")
PLACEHOLDERS = {"email": "<<EMAIL>>", "phone": "<<PHONE>>", "national_id": "<<NATIONAL_ID>>", "address": "<<ADDRESS>>", "name": "<<PERSON>>"}

# Frequent given names of several languages (lower case).
GIVEN = (
    "james john robert michael william david richard joseph thomas charles christopher daniel matthew anthony mark steven paul andrew joshua kenneth "
    "kevin brian george edward ronald timothy jason jeffrey ryan jacob gary nicholas eric jonathan stephen larry justin scott brandon benjamin samuel "
    "mary patricia ann jennifer linda elizabeth barbara susan jessica sarah karen nancy lisa margaret betty sandra ashley emily donna michelle carol amanda "
    "melissa deborah stephanie rebecca sharon laura cynthia kathleen amy angela anna emma olivia sophia julia alice claire hannah lucy ruth "
    "hans klaus jürgen wolfgang dieter stefan andreas christian martin peter michaela monika sabine petra susanne heike ursula ingrid helga "
    "jean pierre michel philippe alain nicolas marie nathalie isabelle sylvie catherine sophie luc camille "
    "josé juan carlos luis javier miguel pablo diego maría carmen ana isabel lucía marta elena rosa sofía "
    "marco giovanni francesco luca giulia chiara lars erik nils ingmar astrid freja ivan sergei dmitri olga natalia svetlana irina "
    "mohammed ahmed ali omar hassan fatima aisha leila priya rahul anil sunita deepa wei ming li hiroshi yuki kenji mei"
).split()
# Titles before a surname, words that go before a person, and words that go after one.
TITLES = ("mr", "mrs", "ms", "miss", "dr", "prof", "frau", "herr", "herrn", "mme", "mlle", "m.", "monsieur", "madame", "sr", "sra", "srta", "señor", "señora", "sir")
BEFORE = (
    "with", "attention", "attention of", "attn", "attn:", "attention:", "att:", "contact", "contact:", "contacts:", "contacted", "signed", "signed:", "signed by", "signature:", "by",
    "ask", "asked", "asking", "under", "cc", "cc:", "bcc:", "and", "our", "my", "their", "tell", "told", "call", "called", "phone", "phoned", "email", "emailed", "reach", "to", "from", "for", "met", "meet", "know", "knows", "per", "via", "between",
    "dear", "hi", "hello", "hallo", "hola", "bonjour", "c/o", "formerly", "previously", "once", "regards,", "sincerely,", "cheers,", "name:", "name is", "named", "behalf of", "herrn und frau",
    "buyer,", "seller,", "manager,", "director,", "lead,", "engineer,", "officer,", "owner,", "counsel,", "specialist,", "assistant,", "colleague,", "customer,", "client,", "employee,", "person:",
    "zu händen", "z. hd.", "mit", "von", "an", "laut", "à l'attention de", "avec", "selon", "chez", "atención de", "con", "a", "según", "por", "de parte de",
)
#: Of the words before, those that also announce a name in lower case.
ANNOUNCE = frozenset(
    "attention attn attn: attention: att: contact: contacts: signed: signature: dear c/o formerly previously name: named person: between with per buyer, seller, manager, director, owner, counsel,".split()
) | {"signed by", "attention of", "zu händen", "à l'attention de", "atención de", "behalf of"}
AFTER = (
    "asked", "asks", "said", "says", "wrote", "writes", "signed", "signs", "called", "calls", "confirmed", "confirms", "agreed", "agrees", "approved", "approves", "told", "left", "leaves", "joined",
    "joins", "replied", "replies", "requested", "requests", "needs", "wants", "holds", "held", "has", "will", "can", "is", "was", "promised", "insists", "thinks", "explained", "mentioned", "noted", "offered", "from the", "from our",
    "from their", "'s", "’s", "schrieb", "bat", "sagte", "a écrit", "a demandé", "escribió", "pidió",
)
# Words of companies, and of places and things that are called like persons.
COMPANY = frozenset(
    "inc ltd llc corp gmbh ag sa se bv nv plc co company corporation limited group holding holdings partners solutions systems services networks software technologies technology labs media energy "
    "logistics industries bank capital consulting health foods robotics payments platforms analytics insurance international global associates ventures works motors airlines pharma telecom "
    "ridge harbour harbor hub centre center campus park gate bay bridge street road avenue lane court square office desk team department suite edition module bundle plan".split()
)
# Cues of identity numbers.
ID_CUES = (
    "ssn", "social security", "social:", "identity number", "identity no", "identity card", "id card", "id no", "national id", "tax id", "tax number",
    "steuer-id", "steuernummer", "national insurance", "ni number", "nino", "passport", "reisepass", "passeport", "pasaporte", "dni", "nie", "nif",
    "driver's licence", "driver's license", "driver’s licence", "driving licence", "drivers licence", "driver license", "führerschein",
    "permis de conduire", "personalausweis", "ausweisnummer", "carte d'identité", "sécurité sociale", "tin", "itin", "curp", "licence no", "license no",
)
STREETS = (
    "street", "st", "avenue", "ave", "boulevard", "blvd", "lane", "ln", "road", "rd", "court", "ct", "drive", "dr", "parkway", "pkwy", "place", "pl", "way",
    "terrace", "square", "sq", "quay", "row", "circle", "highway", "hwy", "close", "crescent", "gardens", "hill", "mews", "walk", "alley", "trail", "loop", "plaza",
)
STREETS_BEFORE = ("rue", "avenue", "boulevard", "quai", "place", "chemin", "allée", "impasse", "cours", "route", "square", "passage")
STREETS_ES = ("calle", "avenida", "avda.", "plaza", "paseo", "camino", "carrera", "ronda", "travesía", "c/")
STREETS_DE = ("straße", "strasse", "str.", "gasse", "weg", "platz", "allee", "ring", "damm", "ufer", "steig", "markt")

_UP, _LOW = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
_WORD = rf"(?:[{_UP}]{{2,}}(?:['’-](?!S\b)[{_UP}]{{2,}})*(?![{_LOW}])|[{_UP}][{_LOW}]*(?:['’-](?!s\b)[{_UP}]?[{_LOW}]+)*)"
_EMAIL_LOCAL = re.compile(r"[\w.+%'-]+$")
_EMAIL_HOST = re.compile(r"(?:[A-Za-z0-9-]+(?:\.|\s?[\[(]\s?(?:dot|punkt|point|punto)\s?[\])]\s?))+[A-Za-z]{2,}")
_NUMBERS = re.compile(r"(?<![\w#$€£.,/-])(?:\+|\()?\d[\d().\-/  ]{5,}\d")
_PHONES = re.compile(
    r"\+?1?[-. ]?\([2-9]\d\d\)[-. ]?\d{3}[-. ]?\d{4}|(?:\+?1[-. ])?[2-9]\d\d([-. ])\d{3}\1\d{4}|(?:\+?1)?[2-9]\d\d[2-9]\d{6}"
    r"|\+\d{1,3}[-. ]?(?:\(0\)[-. ]?)?\d{1,4}(?:[-. ]?\d{2,5}){1,5}|0[1-9](?:([-. ])\d\d)(?:\2\d\d){3}|(?:\(0\d{1,4}\)|0\d{1,4})[-. /]\d{3,5}[-. ]\d{3,5}"
)
_NOT_PHONE = re.compile(r"(?:order|sku|serial|lot|ticket|invoice|no|nr|number|build|part|item|ref|reference|version|account|company)\.?\s?[#:]?\s?$", re.I)
_ID_FILL = re.compile(r"\s*(?:(?:number|no|nr|num|card|on file|is|was|of|the|#|:|\.)[\s.:]*)*", re.I)
_ID_TOKEN = re.compile(r"(?:[A-Z]{1,3}[ -]?)?\d[\dA-Z]*(?:[ -](?:\d[\dA-Z]*|[A-Z](?![\w])))*|[A-Z]\d{3,}[\w-]*")
_HOUSE = re.compile(r"(?<![\w$€£.,-])\d{1,5}(?:-?[A-Za-z])?\s$")
_NAME_FORMS = (
    rf"(?P<a>{_WORD}, {_WORD}(?: [{_UP}]\.)?)",
    rf"(?P<b>(?:{_WORD}|[{_UP}]\.)(?: (?:[{_UP}]\.|van|von|de|der|den|la|del|di|bin|al|{_WORD}))* {_WORD})",
    rf"(?P<c>{_WORD})",
)
_NAME = re.compile("|".join(_NAME_FORMS))
_TITLED = re.compile(rf"(?:(?:[Mm]rs?|MRS?|[Mm]s|MS|[Mm]iss|[DdPp]r(?:of)?|DR|Frau|Herrn?|Mme|Mlle|M|Monsieur|Madame|Sra?|Srta|Señora?|Sir)\.? )+")
_LOWER_NAME = re.compile(rf"[{_LOW}]+ (?:[{_LOW}]\. )?[{_LOW}]{{3,}}")
_NOT_NAME = frozenset(
    "The A An In On At For Of And Or If No Not Per Under Given Separately According During Section Invoice Reference Delivery Support Switching Savings Unless With Our Two "
    "January February March April May June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday "
    "Street Avenue Road Court Lane Box Reach Contact Signed Dear Please Hello Hi Regards Attention".split()
)
Names = frozenset[str]


@cache
def _common() -> frozenset[str]:
    """Common words: those that a public tokenizer's vocabularies hold whole, in lower case, after a blank."""
    import base64

    import public_tokenizers

    words = set()
    for name, least in (("byte_bpe_50k.tiktoken", 3), ("byte_bpe_multi_50k.tiktoken", 4)):
        with open(public_tokenizers.path(name), "rb") as f:
            for line in f:
                token = base64.b64decode(line.split()[0]).decode("utf-8", "ignore")
                if token[:1] == " " and len(token) > least and token[1:].isalpha() and token[1:].islower():
                    words.add(token[1:])
    return frozenset(words)


@cache
def _automaton(given: Names) -> ahocorasick.Automaton:
    found: dict[str, str] = {}
    for words, kind in (
        (("@", "(at)", "[at]", "{at}", "mailto:"), "email"), (ID_CUES, "id"), (("p.o. box", "po box", "p. o. box", "post office box", "postfach", "apartado", "boîte postale"), "box"),
        (STREETS, "street"), (STREETS_BEFORE, "rue"), (STREETS_ES, "calle"), (STREETS_DE, "strasse"), (given, "given"), (TITLES, "title"), (BEFORE, "before"), (AFTER, "after"),
    ):
        for word in words:
            found[word] = f"{found[word]} {kind}" if word in found else kind
    made = ahocorasick.Automaton()
    for word, kinds in found.items():
        made.add_word(word, (word, tuple(kinds.split())))
    made.make_automaton()
    return made


def _email(text: str, at: int, word: str) -> tuple[int, int] | None:
    """Expand an at-sign, or a spelling of it, to both sides."""
    if word == "mailto:":
        return None
    left = text[max(0, at - 80) : at]
    if word != "@" or left.endswith(" "):
        left = left[:-1] if left.endswith(" ") else left
    gap = text[at + len(word) : at + len(word) + 1] == " "
    local = _EMAIL_LOCAL.search(left)
    host = _EMAIL_HOST.match(text, at + len(word) + gap)
    if not local or not host:
        return None
    begin = max(0, at - 80) + local.start()
    while begin < at and not (text[begin].isalnum() or text[begin] == "_"):
        begin += 1
    return (begin, host.end()) if begin < at else None


def _identity(text: str, end: int) -> tuple[int, int] | None:
    """The identity number that follows a cue, after fillers such as "number", "on file is", "no."."""
    start = _ID_FILL.match(text, end).end()
    token = _ID_TOKEN.match(text, start)
    if not token or start - end > 30 or sum(c.isdigit() for c in token[0]) < 5:
        return None
    return token.span()


_SHORT = frozenset("st ave blvd ln rd ct dr pkwy pl sq hwy".split())
_UNIT = re.compile(rf",? (?:(?:Suite|Ste\.?|Apt\.?|Unit|Floor|Flat|Room|#) ?\w{{1,5}}|\d{{1,2}}º ?[A-Z]?)\b|, \d{{4,5}} [{_UP}][{_LOW}]+")


def _whole(text: str, span: tuple[int, int] | None) -> tuple[int, int] | None:
    """An address with the unit or the postcode and town that follow it."""
    more = span and _UNIT.match(text, span[1])
    return (span[0], more.end()) if more else span


def _street(text: str, begin: int, end: int) -> tuple[int, int] | None:
    """A house number, one to four capitalised words and a street word."""
    if not text[begin].isupper() or (end < len(text) and (text[end].isalnum() or text[end] == "-")):
        return None
    left, at, words = begin, begin, 0
    while words < 5:
        before = re.search(r"(?:^|(?<=\s))(\S+)\s$", text[max(0, at - 40) : at])
        if not before:
            return None
        word = before[1]
        at = max(0, at - 40) + before.start(1)
        if re.fullmatch(r"\d{1,5}(?:-?[A-Za-z])?", word):
            if not words or (at and text[at - 1] not in " \n\t(;:,"):
                return None
            return at, end + (text[end : end + 1] == "." and text[begin:end].lower() in _SHORT)
        if not (word[0].isupper() and re.fullmatch(r"[^\W\d_](?:[\w'’.-]*)", word)):
            return None
        left, words = at, words + 1
    return None


def _rue(text: str, begin: int, end: int) -> tuple[int, int] | None:
    house = re.search(r"(?<![\w$€£.,-])\d{1,4}(?: ?(?:bis|ter|quater))?,? $", text[max(0, begin - 16) : begin])
    if not house or text[end : end + 1] != " ":
        return None
    tail = re.match(rf" (?:(?:du|de la|des|de|d'|de l'|l'|le|la)\s?)?[{_UP}][\w'’-]*(?: (?:(?:du|des|de|la|le) )?[{_UP}][\w'’-]*)*", text[end : end + 60])
    return (max(0, begin - 16) + house.start(), end + tail.end()) if tail else None


def _calle(text: str, begin: int, end: int) -> tuple[int, int] | None:
    tail = re.match(rf"[ ]?(?:(?:de|del|la|las|los|el) )*[{_UP}][\w'’-]*(?: (?:(?:de|del|la|las|los|y) )*[{_UP}][\w'’-]*)*,? (?:n\.?º ?|núm\.? ?)?\d{{1,4}}\b", text[end : end + 80])
    return (begin, end + tail.end()) if tail and (not begin or not text[begin - 1].isalnum()) else None


def _strasse(text: str, begin: int, end: int) -> tuple[int, int] | None:
    number = re.match(r" \d{1,4} ?[a-z]?\b(?![.,]?\d)", text[end : end + 8])
    if not number:
        return None
    word = re.search(rf"(?:(?:Alte|Neue|Alter|Neuer|Altes|Am|An der|An den|Auf der|Auf dem|Im|In der|Zum|Zur|Große|Kleine|Obere|Untere|Hohe|Lange|Breite|Sankt|St\.) )*[{_UP}][\w-]*$", text[max(0, begin - 50) : begin])
    if not word:
        return None
    at = max(0, begin - 50) + word.start()
    return (at, end + number.end()) if not at or not text[at - 1].isalnum() else None


def _phone(text: str, begin: int, end: int) -> tuple[int, int] | None:
    if _NOT_PHONE.search(text[max(0, begin - 24) : begin]):
        return None
    found = _PHONES.match(text, begin) or (text[begin] == "(" and _PHONES.match(text, begin + 1)) or None
    if not found or (found.end() < len(text) and (text[found.end()].isalnum() or re.match(r"[-.,/]\d", text[found.end() : found.end() + 2]))):
        return None
    digits = sum(c.isdigit() for c in found[0])
    if not 8 <= digits <= 15:
        return None
    if found[0].isdigit() and text[max(0, begin - 1) : begin] in ("-", "_"):
        return None
    return found.span()


def _words(text: str) -> list[str]:
    """The words of a name; parts joined by hyphens or apostrophes are one."""
    return re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", text)


def _bears(words: list[str], given: Names, comma: bool) -> bool:
    """Whether words can be a person's: no word of a company, a surname that is no common word, a given name before it.

    With ``comma`` the surname stands first. A given name need not be a known one, but then it too is no common word.
    """
    low = [w.lower() for w in words]
    if comma:
        low = [*low[1:], low[0]]
    while len(low) > 2 and len(low[-2]) == 1:  # initials between
        low.pop(-2)
    if any(w in COMPANY for w in low) or any(w.capitalize() in _NOT_NAME and w not in given for w in low if len(w) > 1):
        return False
    first, last = low[0], low[-1]
    if len(last) < 3:
        return False
    strange = last not in _common()
    return strange and (len(first) == 1 or first in given or first not in _common()) or (first in given and len(first) > 2 and not words[0].islower())


def _person(text: str, at: int, given: Names, announced: bool = False) -> tuple[int, int] | None:
    """A name that starts at ``at``, after a title or another cue; ``announced`` where it may be in lower case."""
    titled = _TITLED.match(text, at)
    if titled:
        at = titled.end()
    found = _NAME.match(text, at)
    if not found:
        lower = _LOWER_NAME.match(text, at)
        words = lower[0].replace(".", "").split() if lower else [""]
        return lower.span() if announced and words[0] in given and _bears(words, given, False) else None
    words = _words(found[0])
    if found["a"]:
        if _bears(_words(re.sub(r" .\.$", "", found[0])), given, True):
            return found.span()
        # A surname alone before a comma, or a full name before one: the part before it.
        before = re.match(rf"{_WORD}", text[at : found.end()])
        return (at, at + before.end()) if titled else None
    if found["b"]:
        good = not any(w.lower() in COMPANY for w in words) if titled else _bears(words, given, False)
        return found.span() if good else None
    return found.span() if titled and words[0].capitalize() not in _NOT_NAME else None


_BACK = re.compile(
    rf"(?:(?P<b>{_WORD}, {_WORD}(?: [{_UP}]\.)?)|(?P<f>(?:{_WORD}|[{_UP}]\.) (?:[{_UP}]\. |(?:van|von|de|der|den|la|del|di|bin|al) )*{_WORD})|(?P<l>[{_LOW}]+ (?:[{_LOW}]\. )?[{_LOW}]+))"
    r"(?: \([^()\n]*(?:\([^()\n]*\)[^()\n]*)*\))?,? ?$"
)
_HELD_NAME = re.compile(r"\((?:formerly |previously |now |once )?(?P<n>[^()\n\d@]{3,40})\)\s?$")


def _before(text: str, end: int, given: Names) -> tuple[int, int] | None:
    """A name that ends at ``end``, but for a bracket behind it."""
    start = max(0, end - 90)
    part = text[start:end]
    if held := _HELD_NAME.search(part):
        return _person(text, start + held.start("n"), given, True)
    back = _BACK.search(part)
    if not back:
        return None
    kind = back.lastgroup
    at, stop = start + back.start(kind), start + back.end(kind)
    if at and (text[at - 1].isalnum() or text[at - 1] in "-'’"):
        return None
    words = _words(re.sub(r" .\.$", "", text[at:stop]) if kind == "b" else text[at:stop])
    titled = _TITLED.match(text, at)
    if titled and titled.end() < stop:
        return _person(text, at, given)
    if kind == "l" and words[0] not in given:
        return None
    return (at, stop) if _bears(words, given, kind == "b") else None


_CLOSE = re.compile(r" ?[(<\[]?(?:tel\.?|phone|t|mobile|mailto:)?:? ?$", re.I)


def _beside(text: str, begin: int, given: Names) -> tuple[int, int] | None:
    """A name directly before an address, number or its bracket."""
    lead = _CLOSE.search(text[max(0, begin - 12) : begin])
    at = max(0, begin - 12) + lead.start()
    return _before(text, at, given) if lead[0].strip() else None


def _spans(text: str, given: Names) -> Iterator[tuple[str, int, int]]:
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    for last, (word, kinds) in _automaton(given).iter(low):
        begin, end = last - len(word) + 1, last + 1
        open_left = begin == 0 or not low[begin - 1].isalnum()
        open_right = end == len(low) or not low[end].isalnum()
        for kind in kinds:
            got = None
            if kind == "email":
                got = ("email", _email(text, begin, word))
            elif kind == "id" and open_left and open_right:
                got = ("national_id", _identity(text, end))
            elif kind == "box" and open_left:
                number = re.match(r"(?: de correos)?,? ?(?:no\.? |nr\.? )?\d{1,6}(?:[ ]?\d{2,3})?\b", text[end : end + 24])
                got = ("address", (begin, end + number.end()) if number else None)
            elif kind == "street" and open_left and open_right:
                got = ("address", _street(text, begin, end))
            elif kind == "rue" and open_left and open_right:
                got = ("address", _rue(text, begin, end))
            elif kind == "calle" and open_left:
                got = ("address", _calle(text, begin, end))
            elif kind == "strasse" and (not open_left or text[begin : begin + 1].isupper()):
                got = ("address", _strasse(text, begin, end))
            elif kind == "title" and open_left and text[begin].isupper():
                got = ("name", _person(text, begin, given))
            elif kind == "before" and open_left and text[end : end + 1] == " ":
                got = ("name", _person(text, end + 1, given, word in ANNOUNCE))
                if got[1] and word == "between" and text.startswith(" and ", got[1][1]) and (other := _person(text, got[1][1] + 5, given, True)):
                    yield "name", *other
            elif kind == "given" and open_left and open_right:
                yield from _around(text, begin, end, given)
            elif kind == "after" and open_right and (text[begin - 1 : begin] in (" ", ")") or word[0] in "'’"):
                got = ("name", _before(text, begin, given))
            if got and got[1]:
                yield got[0], *(_whole(text, got[1]) if got[0] == "address" else got[1])
                if got[0] in ("email", "national_id") and (name := _beside(text, got[1][0], given)):
                    yield "name", *name
    for run in _SET_OFF.finditer(text):
        if (name := _person(text, run.end(), given)) and text[name[1] : name[1] + 1] == ",":
            yield "name", *name
    for run in _NUMBERS.finditer(text):
        if span := _phone(text, *run.span()):
            yield "phone", *span
            if name := _beside(text, span[0], given):
                yield "name", *name


_SET_OFF = re.compile(rf"(?<![\w-])[{_LOW}]{{3,}}, (?=[{_UP}])")
_INITIAL_LAST = re.compile(rf"(?: (?:[{_UP}]\.|van|von|de|der|den|la|del|di|bin|al))* (?:{_WORD})")


def _around(text: str, begin: int, end: int, given: Names) -> Iterator[tuple[str, int, int]]:
    """A given name with a surname behind it, or before it and a comma."""
    word = text[begin:end]
    if not word[0].isupper():
        return
    tail = _INITIAL_LAST.match(text, end)
    if tail and tail[0].split()[-1].isupper() == word.isupper() and tail[0].split()[-1].lower() not in _common() and _bears(_words(text[begin : tail.end()]), given, False):
        yield "name", begin, tail.end()
        return
    lead = re.search(rf"({_WORD}), $", text[max(0, begin - 30) : begin])
    if lead and lead[1].isupper() == word.isupper() and lead[1].lower() not in _common() and _bears([lead[1], word], given, True):
        at = max(0, begin - 30) + lead.start()
        if at == 0 or not text[at - 1].isalnum():
            yield "name", at, end


_HELD = re.compile(r"<<[^<>\n]{1,80}>>")


_GIVEN: Names = frozenset(GIVEN)


def find(text: str | None, given: Names = _GIVEN) -> list[tuple[str, int, int]]:
    """Non-overlapping ``kind, start, end`` in order of position; positions count code points."""
    if not text:
        return []
    # Disjoint ranges in order of position; a candidate only has to be held against its neighbours.
    taken: list[tuple[int, int, str]] = [(*m.span(), "") for m in _HELD.finditer(text)]
    for kind, begin, end in sorted(set(_spans(text, given)), key=lambda s: (KINDS.index(s[0]), s[1] - s[2], s[1])):
        at = bisect_left(taken, (begin,))
        if (at == 0 or taken[at - 1][1] <= begin) and (at == len(taken) or end <= taken[at][0]):
            taken.insert(at, (begin, end, kind))
    return [(kind, begin, end) for begin, end, kind in taken if kind]


def redact(text: str | None, given: Names = _GIVEN) -> str | None:
    """The text with typed placeholders in place of personal data."""
    if not text:
        return text
    out, at = [], 0
    for kind, begin, end in find(text, given):
        out += [text[at:begin], PLACEHOLDERS[kind]]
        at = end
    return "".join([*out, text[at:]])


def _long(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    pairs: Column = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in columns])
    return df.select(F.col(key).cast("string").alias("record_id"), F.inline(F.filter(pairs, lambda x: x["text"] != "")))


# Documented bound: bytes of learned given names that are broadcast.
MAX_NAME_BYTES = 16_000_000


def known_names(df: DataFrame, columns: list[str], least: int = 2) -> Names:
    """Given names from columns that hold names of persons: first words that stand before ``least`` or more surnames.

    Counted over all rows; the words alone come to the driver, after a check of their size.
    """
    held = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("n"))
    pairs = held.select(F.split(F.trim(F.lower("n")), r"\s+").alias("w")).where(F.size("w").between(2, 4)).select(F.element_at("w", 1).alias("g"), F.element_at("w", -1).alias("s"))
    words = pairs.where(F.length("g") > 1).groupBy("g").agg(F.approx_count_distinct("s").alias("n")).where(F.col("n") >= least).select("g")
    rows = words.toLocalIterator()
    names, size = set(GIVEN), 0
    for row in rows:
        size += len(row.g)
        if size > MAX_NAME_BYTES:
            raise ValueError("more given names than are broadcast; raise `least`")
        names.add(row.g)
    return frozenset(names)


def found(df: DataFrame, key: str, columns: list[str], given: Names = _GIVEN) -> DataFrame:
    """``field, record_id, kind, start_pos, end_pos`` of each piece of personal data in the columns."""
    sent = df.sparkSession.sparkContext.broadcast(given)

    def each(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"kind": k, "start_pos": b, "end_pos": e} for k, b, e in find(t, sent.value)])

    spans = F.pandas_udf(each, "array<struct<kind:string,start_pos:bigint,end_pos:bigint>>")
    return _long(df, key, columns).select("field", "record_id", F.inline(spans("text")))


def redacted(df: DataFrame, key: str, columns: list[str], given: Names = _GIVEN) -> DataFrame:
    """``field, record_id, redacted`` of every non-empty text in the columns."""
    sent = df.sparkSession.sparkContext.broadcast(given)

    def each(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: redact(t, sent.value))

    return _long(df, key, columns).select("field", "record_id", F.pandas_udf(each, "string")("text").alias("redacted"))
