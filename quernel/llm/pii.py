"""Personal information in free text: candidates, boosted trees, typed placeholders.

High-recall generators propose overlapping spans of every kind; names are proposed by their shape, every
two or more words with capitals next to each other, particles between them or not; each span is
described by its format, by how much its words look like names, and by the words and finds around
it; boosted trees, one set per kind, trained once on the labelled sentences of pii_seed and
pii_general, say how likely it is real; cutoffs calibrated on held-out sentences select, and of
overlapping spans the likeliest stays. All of it runs on a folded copy of the text (base letters,
plain digits and spaces, nothing invisible) whose places map back to the original.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quernel.llm.boosting import BoostedTrees

KINDS = ("email", "phone", "id_number", "address", "name")

#: Common given names (English, German, French, Spanish), as folded lower-case words.
GIVEN_NAMES = """
adam adrian alan albert alejandro alexander alfred alice alicia alfonso amanda amelie amy ana andre andrea andreas andrew andres
angela anja anke ann anna anne annette anthony antoine antonio arthur astrid barbel barbara beatriz begona benjamin bernard bernd birgit bjorn
brian brigitte bruno camille carla carlos carmen caroline catherine cecile celine chantal charles charlotte chloe christian christina christine
christophe claire clara claude claudia clemens cristina daniel david deborah denis diana diego dieter dirk dominique donald dorothy edward elena elisa
elisabeth elizabeth elke emilia emily emma enrique eric erik ernst esther etienne eva fabian felix fernando florian frances francisco francois frank
franz frederic friedrich gabriel gabriele george georg gerard gerhard gertrud gilles gloria grace gregory gunter gustav hannah hans heidi heike
heinrich heinz helen helena helene helga helmut henri henry herbert holger holly hugo ignacio ines ingrid inigo irene isabel isabelle ivan jack
jacob jacqueline jacques james jan jane janet javier jean jeffrey jennifer jens jessica joachim joan joaquin johann johanna john jonas jonathan
jorg jorge jose joseph juan judith julia julian julie julien jurgen karen karin karl katharina katherine kathleen katrin kenneth kevin klaus
kurt lars laura laurent lea leon linda lisa louis louise luc lucas lucia lucie luis luisa lukas madeleine maelle manfred manon manuel manuela marc
marcel marco margaret margot maria marie marion mark marko markus marta martin martina mary mateo mathieu matthew matthias maurice max megan
melissa michael michel michele miguel monika monica moritz nadine nancy natalia nathalie nicholas nicolas nicole nora norbert olga oliver olivier
oscar otto pablo pascal patricia patrick paul paula pedro peter petra philip philippe pierre pilar rachel rafael ralf ramon raul raymond rebecca regina
remi rene renate ricardo richard robert roberto roger roland rolf rosa rudolf ruth sabine samuel sandra santiago sara sarah scott sebastian sergio
sharon silke silvia simon simone sofia sophie stefan stefanie stella stephanie stephen steven susan susana susanne sven sylvie teresa theo theodor thomas
thierry tobias tomas torsten ulrich ulrike ursula ute uwe valentin valerie vera veronica veronika victor victoria vincent virginia volker walter
werner wilhelm william wolfgang xavier yves yvonne
aaron abigail adriana agathe agustin alba alvaro angeles annika antje armin arturo bastien benoit bettina britta bruce celia cesar christoph clement colin
cornelia corinne damien delphine dennis diane didier dolores donna doris douglas eduardo elaine ellen elodie emilio ethan evelyn fabien federico felipe fiona fritz gaelle gary gisela
gonzalo gordon graham greta gudrun guillaume guillermo harald harry hartmut heather hector ian ingrid isaac jaime jana jason jerome jesus jimena
julio jutta kai kate keith kelly laetitia lena lewis liam lorena lorenzo lothar lucy ludovic ludwig luke marcos margaux marina marine marlene mathilde mercedes molly morgane
nathan neil nerea nils noemie nuria olaf olivia owen paloma pamela pauline quentin rainer ralph raphael raquel rocio rodrigo romain rosalie ruben ruediger rudiger russell ryan sally salvador samantha
sean sebastien shirley sigrid silvain solene sonja steffen stuart svenja sylvain tanja theodore tim tina tom udo ulf vicente wendy xavi yann yolanda zoe
""".split()

_GIVEN_SET = frozenset(GIVEN_NAMES)

#: Words after which a name is a character of the game.
TITLES = "captain elder sister foreman overseer quartermaster brother-in-arms lord lady king queen prince princess sir warden commander sergeant general priestess apothecary npc".split()

_TITLE_SET = frozenset(TITLES)

#: Small words of five languages that are no part of a name.
SMALL_WORDS = set("""
a about after al also an and another are as at aus auf avec bei but by can con da dans das de dejo del den der des die did dies do du durch e ein eine el elle
en er es est et for fur from gave get gives had has hat have he her here him his how i if il im in is ist it its je la las le les lo los mais me mein mi mit
mon my no nicht nor not nous o oder of off on only opens or our over para par pas pero plus por pour pro que qui said says se sein sein sells she si sich sie sin
so son sont sous spawns su sur tan than thanks that the their them then there they this to too told un una und une until up us use va van vom von vor wanted
war was we wenn were what when where which who whoever wie will wir with wrote y yes you your zu zum zur used found first near past towards between under behind
inside along before period day mode
""".split())  # fmt: skip

_LABELS = {
    "email": r"(?:mail|e-mail|mailto|contact|schreibt an|escribid a|ecrivez a|wrote|write to|reported by|cc|from|reach me at)\W*$",
    "phone": r"(?:tel|telefon|telephone|phone|call|call me on|call me at|text|number is|numero es|appelez le|llamame al|ruft an|mobil|handy|movil|fax|whatsapp|ring|contact|or|reported by)\W*$",
    "id_number": r"(?:ssn|passport|id card|identity number on file|identity number|id number|personalausweis|ausweisnummer|ausweis|dni|nie|nif|reisepass|pasaporte|passeport|numero|social security|national insurance|insurance no)\W*$",
    "address": r"(?:lives at|live at|map to|wohnt in der|wohnt im|wohnt am|wohnt|vive en|habite au|habite|la carte au|carte au|el mapa a|karte bitte an|bitte an|ship to|send it to|address|adresse|direccion|meetup is at|deliver to|come to|moved to|an)\W*$",
    "name": r"(?:my real name is|thanks to|i told|reported by|ask for|author|doxxed someone|best|regards|saludo|grusse|gruss|cordialement|brother|frere|hermano|bruder|gemeldet von|signale par|avisado por|merci a|danke an|gracias a|my name is|ich heisse|me llamo|je m'appelle|signed|sister-in-law|cousin|friend|and|und|et|y|real name|contact|by|opens|skip it)\W*$",
}
_AFTER = {
    "email": r"\W*(?:wrote|if the|falls|si el|si le|or\b|and\b)",
    "phone": r"\W*(?:after|personalausweis|[)])",
    "id_number": r"\W*(?:to restore|was asked|wollte|tel\b)",
    "address": r"\W*(?:schicken|ask for|flat\b|apt\b|\d{5}|[a-z]{2}\d ?\d[a-z]{2}|[a-z]{2} \d{5}|bajo|\d+\.)|,? ?[\w'-]+(?: [\w'-]+){0,2},? (?:[a-z]{2}\d ?\d[a-z]{2}|[a-z]{2} \d{5}|\d{5})",
    "name": r"\W*(?:lives at|wohnt|vive en|habite|and my number|for testing|about it|found it|war schneller|l'a trouve|lo encontro|pour le test|fur das|fur den|por probar|por la|furs testen|mail=|[(]|and|und|y|et|;)",
}
_GAME = {
    "email": r"npc:",
    "phone": r"(?:#|id=|ticket|build|version|v|for|hits for|asks for|kill count|[(\[]|near|at|bei|en|commit|guid|\d[.,]|/|seen on|gesehen am|vu le|visto el|since|seit|edit|level|by|of)\W*$",
    "id_number": r"(?:#|id=|ticket|build|version|for|hits for|asks for|kill count|commit|guid|creature-[\d-]*|/|item=|npc/)\W*$",
    "address": r"(?:inn on|sells [\w ]+ at|stalls?|shop at|along|quest|guards)\W*$",
    "name": r"(?:called|vendor|guards|north of|south of|sells|npc:|beside|once|north|sudlich von|stamp from|mail to|call for|ask|tell|quest|near|where|to)\W*$",
}
_GAME_AFTER = {
    "email": r"(?!)",
    "phone": r"\W*(?:damage|reputation|kills|xp|gold|/|[%\])]|st\b|[.,]\d)",
    "id_number": r"\W*(?:damage|reputation|kills|/)",
    "address": r" (?:stalls?|in [a-z]+|market|shop|to\b)",
    "name": r"\W*(?:sells|spawns|dies|patrols|despawns|stands|gives|just leaves|is bugged|refuses|wants|used to|at \d|three times|is not to be|@|- [(\[])",
}


#: Words that say, somewhere near, what a span is.
_CUES = {
    "email": r"\b(?:e-?mail|mail|contact|reach|write|from|to)\b",
    "phone": r"\b(?:phone|tel|telefon\w*|telephone|tel|mobile?|handy|cell|fax|call\w*|ring|text|whatsapp|number|reach|anruf\w*|angerufen|llam\w*|appel\w*)\b",
    "id_number": r"\b(?:nhs|insurance|passport|licen[cs]e|licence|tax|steuer\w*|sozial\w*|codice|fiscale|aadhaar|pesel|bsn|personnummer|ssn|social|securite|sociale|identit\w+|id|ausweis\w*|reisepass|dni|nie|nif|born)\b",
    "address": r"\b(?:lives?|living|address|adresse|direccion|deliver\w*|ship|send|moved|package|wohn\w*|vive|habite|abit\w+|treffpunkt|met|meet\w*|at)\b",
    "name": r"\b(?:mr|mrs|ms|miss|dr|prof|herr|frau|monsieur|mme|madame|senor|senora|sr|sra|signora?|pan|pani|name|named|called|signed|signature|regards|sincerely|dear|hi|hello|contact|call|ask|customer|client|patient|tenant|passenger|colleague|neighbour|neighbor|teacher|lawyer|doctor|witness|applicant|friend|person|from|by|with|mit|avec|con|von|grussen|saludos|cordialement|cc|met|hired)\b",
}
_CUE = {k: re.compile(v) for k, v in _CUES.items()}
_CUE_AT_END = re.compile(_CUES["name"] + r"\W*$")
#: What persons do, behind a name; and what only happens in a game, on either side.
_DOES = re.compile(r"(?:'s)?\W*(?:lives|lived|said|says|wrote|sent|called|works|worked|signed|born|told|phoned|replied|joined|moved|paid|booked|checked|left|will|has|hat|wohnt|a|vive|abita|checked|tel|phone|<|\+|again|this|about|for|in today)\b")
_PLAY = re.compile(r"\b(?:quests?|npc|boss|vendor|spawns?|patrols?|loot|drops?|level|lvl|raid|dungeon|kill|mob|guards?|sells|respawn\w*|guild|hits|chest|gold|stands near)\b|\d\d?\.\d, ?\d\d?\.\d")
#: Words with a capital, and what joins them to a name.
_CAPITAL = r"[A-ZŁØÆÐÞŒÇΑ-ΩА-ЯЁ]"
_LETTER = r"[^\W\d_\u0e00-\u0eff\u3040-\u9fff\uac00-\ud7af]"
_PART = rf"(?:{_CAPITAL}{_LETTER}*(?:['-]{_LETTER}+)*)"
_PARTICLE = r"(?:(?:de|la|las|los|del|della|van|von|der|den|ten|ter|di|da|do|dos|das|du|le|bin|ibn|al|el|ben|zu|zum|af|y|e)\.? ){1,3}"
_PIECE = re.compile(_PART)
_JOINED = re.compile(rf" {_PARTICLE}")
#: A span proposed by its shape whose words look less like names than this, on average, is not considered: 0.6 in a hundred names.
_UNLIKE = -0.6


def _shapes(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, form) of two to four words with capitals next to each other, 5 to 7, or turned round a comma, 8.

    Not behind an article, and not with a title: those are things, or characters of the game.
    """
    run: list[tuple[int, int, float]] = []
    turned: tuple[int, float] | None = None
    size = len(text)
    for m in _PIECE.finditer(text):
        a, b = m.span()
        word = m[0].lower()
        if b - a > 1 and (word in SMALL_WORDS or word in _TITLE_SET):
            run, turned = [], None
            continue
        gap = text[run[-1][1] : a] if run and a - run[-1][1] < 16 else ""
        if not gap and a and (text[a - 1] in "@+'-_." or text[a - 1].isalnum()) or b < size and (text[b] in "@_" or text[b].isdigit()):
            run, turned = [], None  # inside a word, a mail address or a name on a screen
            continue
        here = (a, b, likeness(word) if b - a > 1 else 0.0)
        if gap != " " and not (gap == ". " and run[-1][1] - run[-1][0] == 1) and not (3 < len(gap) < 16 and _JOINED.fullmatch(gap)):
            turned = (run[-1][0], run[-1][2]) if gap == ", " and run[-1][1] - run[-1][0] > 1 else None
            run = []
        run.append(here)
        if turned is not None and b - a > 1 and len(run) < 3 and turned[1] + sum(x[2] for x in run) >= _UNLIKE * (len(run) + 1):
            yield turned[0], b, 8
        if b - a > 1:
            total, known = here[2], 1
            for n in range(2, min(4, len(run)) + 1):
                first = run[-n]
                if first[1] - first[0] > 1:
                    total, known = total + first[2], known + 1
                if total >= _UNLIKE * known and text[max(0, first[0] - 5) : first[0]].rpartition(" ")[0].rpartition(" ")[2].lower() not in _ARTICLES:
                    yield first[0], b, 3 + n


class _Around:
    """What the spans of one text have around them."""

    def __init__(self, found: list[tuple[str, int, int, int]]) -> None:
        self.others = sorted(p for kind, a, b, _ in found if kind != "name" for p in (a, b))

    def near(self, start: int, end: int) -> bool:
        """Whether a candidate of another kind is within 40 places."""
        n = bisect_left(self.others, start - 40)
        return n < len(self.others) and self.others[n] < end + 40


_CUE_WORDS = frozenset(re.findall(r"[a-z]{2,}", _CUES["name"].replace("\\b", " ").replace("(?:", " ").replace("?", " ")))
_ARTICLES = frozenset("the a an this that der die das den dem ein eine einen le la les un une el los las una lo il gli objet objeto l".split())
_DOES_WORDS = frozenset("lives lived said says wrote sent called works worked signed born told phoned replied joined moved paid booked checked left will has hat wohnt vive abita habite tel phone and und et y".split())


#: Endings of words that say how something is done.
_ADVERBS = ("ly", "ment", "mente", "weise")
_EDGE = ".,:;!?()<>\"'"


def shape_features(text: str, low: str, around: _Around, start: int, end: int, form: int) -> list[float]:
    """Words and context of a span proposed as a name by its shape. Such spans are many, so nothing here costs much."""
    span = text[start:end]
    words = [w for w in low[start:end].replace(",", " ").replace(".", " ").split() if w not in SMALL_WORDS or len(w) == 1]
    scores = [likeness(w) for w in words if len(w) > 1] or [0.0]
    before, behind = low[max(0, start - 30) : start].split(), low[end : end + 30].split()
    near, next_ = before[-1].strip(_EDGE) if before else "", behind[0].strip(_EDGE) if behind else ""
    last, first = text[max(0, start - 2) : start], text[end : end + 2]
    return [
        float(form), scores[0], scores[-1], min(scores), sum(scores) / len(scores), float(any(w in _GIVEN_SET for w in words)), float(around.near(start, end)),
        float(near in _CUE_WORDS), float(next_ in _DOES_WORDS or next_.endswith("'s") or low[end : end + 2] == "'s"), float(before[-2].strip(_EDGE) in _CUE_WORDS) if len(before) > 1 else 0.0,
        float(last[:1].isalpha() and last[-1:] == " "), float(text[max(0, start - len(before[-1]) - 1) : start][:1].isupper()) if before else 0.0, float(first[:1] == " " and first[1:].isupper()),
        float(last[-1:] in "\n:,;(" or not last), float(last[:1] in ".!?:" or not last), float(first[:1] in "\n.,;:)<'" or not first), float(span.isupper()),
        float(near in _ARTICLES or near.rpartition("'")[2] in _ARTICLES), float(near in _TITLE_SET), float(span.isupper() and text[max(0, start - 12) : start].isupper()), float(span.isupper() and text[end : end + 12].isupper()),
        float(len(words)), float(sum(map(len, words)) / max(1, len(words))), float(near in SMALL_WORDS), float(next_ in SMALL_WORDS), float(words[-1].endswith(_GAME_ENDINGS)) if words else 0.0, float(_PLAY.search(low, max(0, start - 50), end + 50) is not None), float(low.find("'", start, end) >= 0), float("-" in span), float(words[0].endswith(_ADVERBS)) if words else 0.0,
    ]


def _grams(word: str) -> list[str]:
    whole = f"^{word.lower()}$"
    return [whole[n : n + 3] for n in range(len(whole) - 2)] + [whole[-4:], whole[:4]]


@lru_cache(maxsize=1)
def _gram_weights() -> dict[str, float]:
    from quernel.llm.pii_general import score_words
    from quernel.llm.pii_seed import other_words, personal_words

    persons, others = score_words()
    good = Counter(g for w in [*persons, *GIVEN_NAMES, *personal_words()] for g in _grams(fold(w)[0]))
    bad = Counter(g for w in [*others, *SMALL_WORDS, *other_words()] for g in _grams(fold(w)[0]))
    more, less = sum(good.values()), sum(bad.values())
    return {g: log((good[g] + 1) / more) - log((bad[g] + 1) / less) for g in good.keys() | bad.keys()}


@lru_cache(maxsize=1 << 16)
def likeness(word: str) -> float:
    """How much a word looks like a part of a name: mean log odds of its letters by threes."""
    weights = _gram_weights()
    grams = _grams(word)
    return round(sum(weights.get(g, 0.0) for g in grams) / len(grams), 2)


class _Fold(dict):
    """Single letters to their base letter, compatible form or plain space; length never changes."""

    def __missing__(self, code: int) -> str:
        letter = chr(code)
        if letter.isspace() and letter not in "\n\r":
            folded = " "
        else:
            # base letters, but a letter that decomposes into several stays one letter
            parts = [c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)]
            folded = parts[0] if len(parts) == 1 else letter
        if letter in "‐‑‒–—−":
            folded = "-"
        if letter in "’‘ʼ":
            folded = "'"
        self[code] = folded
        return folded


_FOLD = _Fold()
_GONE = re.compile("[̀-ͯ­͏؜᠎​-‏‪-‮⁠-⁤︀-️﻿]")


def fold(text: str) -> tuple[str, np.ndarray | None]:
    """The folded text and, unless places are the same, the original place of each of its letters."""
    if text.isascii():
        return text.replace("\t", " "), None
    folded = text.translate(_FOLD)
    if _GONE.search(text) is None:
        return folded, None
    gone = np.zeros(len(text), dtype=bool)
    gone[[m.start() for m in _GONE.finditer(text)]] = True
    letters = np.frombuffer(folded.encode("utf-32-le"), dtype="<u4")
    return letters[~gone].tobytes().decode("utf-32-le"), np.flatnonzero(~gone)


_EMAIL = re.compile(r"[\w.+%-]+ ?@ ?[\w-]+(?:\.[\w-]+)+|[\w.+%-]+ ?(?:[(\[] ?at ?[)\]]| AT ) ?[\w-]+(?: ?(?:\.|[(\[] ?dot ?[)\]]| DOT ) ?[\w-]+)+", re.IGNORECASE)
_DIGITS = re.compile(r"(?<![\w#])(?<![\d][.,/:-])(?:\+ ?|\()?\d(?:[ ]?[-./]?[ ]?[()]{0,2}[ ]?\d){6,17}(?!\w)")
_AREA = re.compile(r"\(\d{2,5}\)")
_ID_SHAPES = [
    re.compile(p, re.IGNORECASE)
    for p in (
        r"(?<![\w.-])\d{3}[- ]\d{2}[- ]\d{4}(?![\w-])",
        r"(?<![\w-])[a-z]{2}[- ]?\d{2}[- ]?\d{2}[- ]?\d{2}[- ]?[a-d](?!\w)",
        r"(?<![\w-])[a-z]{1,2}[- ]?\d{6,8}(?:-?[a-z])?(?![\w-])",
        r"(?<![\w-])[a-z]\d[a-z]\d(?:[ -]?\d){3,6}(?: ?[a-z])?(?!\w)",
        r"(?<![\w.-])\d{2}\.?\d{3}\.?\d{3}[- ]?[a-z](?![\w-])",
        r"(?<![\w.-])[12] ?\d\d ?\d\d ?(?:\d\d|2[ab]) ?\d{3} ?\d{3} ?\d\d(?![\w-])",
        r"(?<![\w.#=,-])(?<!for )\d{9}(?!\w|[.,-]\d)",
        r"(?<![\w.#=,-])\d{3}[ -]\d{3}[ -]\d{4}(?!\w|[.,-]\d)",
        r"(?<![\w.#=,-])\d{2} \d{3} \d{3} \d{3}(?!\w|[.,-]\d)",
        r"(?<![\w.#=,-])\d{4} \d{4} \d{4}(?!\w|[.,-]\d)",
        r"(?<![\w.#=,-])\d{11}(?!\w|[.,-]\d)",
        r"(?<![\w.#=,-])\d{6}[-+a]\d{3}[\da-z](?!\w|[.,-]\d)",
    )
]
#: Letters and digits in one word, as on cards and licences.
_MIXED = re.compile(r"[A-Z]\d{2}[A-Z0-9]{4,12}(?![\w-])")
_LETTERS_BEFORE = re.compile(r"(?<![\w.-])[A-Z]{0,5}$")
_WAY_EN = r"(?:street|str|st|road|rd|avenue|ave|lane|ln|crescent|cres|row|way|drive|dr|close|court|ct|terrace|place|pl|square|sq|boulevard|blvd|walk|gardens|mews|hill)"
_ADDRESSES = [
    re.compile(p, re.IGNORECASE)
    for p in (
        rf"(?<![\w#.,/])(?:(?:flat|apt|unit|suite|room)\.? \w{{1,4}},? )?\d{{1,4}}[a-z]?,? (?:[nsew]\.? |(?:north|south|east|west|old|new) )?(?:[a-z][\w'-]+ ){{1,3}}?{_WAY_EN}\b\.?",
        r"\b[\w-]*\w{3}(?:strasse|straße|str\.|gasse|weg|allee|platz|ufer|ring|damm|steig) ?\d{1,4}(?: ?[a-z])?\b",
        r"(?<![\w#.,/])\d{1,4}(?: ?bis| ?ter)?,? (?:rue|quai|impasse|avenue|av\.|boulevard|bd|place|chemin|allee|cours|route|square|passage)\b(?: de la| de l'| du| des| de| d')?[ ]?[\w'-]+",
        r"(?:\b(?:calle|plaza|pza\.?|avenida|avda?\.?|paseo|camino|ronda|travesia)|\bc/)(?: de la| de los| de las| del| de)? ?[a-z][\w'-]*(?: [a-z][\w'-]+){0,3}?,? (?:n\.?[ºo]? ?)?\d{1,4}\b",
        r"\b[a-z][\w-]+ (?:strasse|straße|str\.|gasse|weg|allee|platz|ufer|ring|damm|steig) ?\d{1,4}(?: ?[a-z])?\b",
        r"\b(?:via|viale|piazza|corso|rua|largo|praca)(?: d[aeio]s?| dell[aeo']| del| san| santa)? ?[a-z][\w'-]*(?: [a-z][\w'-]+){0,2}?,? (?:n\.?[ºo]? ?)?\d{1,4}\b",
        r"\b[a-z][\w-]*(?:straat|laan|gracht|plein|gatan|vagen|gade|vej) ?\d{1,4}(?: ?[a-z])?\b",
        r"\b(?:ul\.|ulica) ?[a-z][\w'-]*(?: [a-z][\w'-]+)? \d{1,4}(?:/\d{1,3})?\b",
        r"\b(?:p\. ?o\. ?box|po box|postfach|apartado) \d{1,6}\b",
    )
]
#: Where an address can be, one pattern per form, cheap to look for: a kind of way with a number near it.
_NUMBER = re.compile(r"\d")
_SURNAME = r"[^\W\d_]{3,}(?:-[^\W\d_]{3,})?"
_NEXT = re.compile(rf" (?:([^\W\d_])\.? )?({_SURNAME})(?![\w@])")
_BEFORE = re.compile(rf"(?<![\w@.+-])({_SURNAME}), $")
_INITIAL = re.compile(rf"(?<![\w.'-])[^\W\d_]\. (?:[^\W\d_]\. )?({_SURNAME})(?![\w@])")
_LAST_INITIAL = re.compile(rf"(?<![\w@.+-])({_SURNAME}), [^\W\d_]\.(?!\w)")
#: Endings of made-up and real family names of several languages.
_ENDINGS = ("son", "sson", "vitch", "ovic", "sky", "ski", "berg", "bridge", "by", "ghby", "cott", "ton", "ham", "ley", "wick", "nard", "mere", "gale", "line", "strom", "nez", "ez", "ske", "ke", "holt", "ardo", "rou", "mann", "stein", "feld", "ner", "eau", "ier", "ard", "ando", "illo", "field", "worth", "land", "wood", "man", "er", "ell")
#: Second halves of names of characters and places in the game.
_GAME_ENDINGS = ("marrow", "gnaw", "latch", "bane", "warden", "thornwick", "briar", "kettle", "lantern", "spindle", "hollow", "mantle", "foot", "barrow", "fen", "fold", "gate", "reach", "shelf", "sound", "strand", "wold", "moor", "drok")


#: Words around which a span is looked for, by kind; names also before and after phrases.
_TRIGGERS = {
    "email": ["@", "(at)", "[at]", "( at )", "[ at ]", " dot ", "[dot]", "(dot)"],
    "address": ["street", *(f" {w}{e}" for w in ("str", "st", "rd", "ave", "ln", "dr", "ct", "pl", "sq") for e in (" ", ".", ",", "\n")), " road", " avenue", " lane", " crescent", " cres", " row", " way", " drive", " close", " court", " terrace", " place", " square", " boulevard", " blvd", " walk", " gardens", " mews", " hill"],
    "strasse": ["strasse", "straße", "str.", "gasse", "weg ", "allee ", "platz ", "ufer ", "ring ", "damm ", "steig "],
    "rue": [" rue ", " quai ", " impasse ", " avenue ", " av.", " boulevard ", " bd ", " place ", " chemin ", " allee ", " cours ", " route ", " square ", " passage "],
    "calle": ["calle ", "plaza ", "pza", "avenida ", "avda", "paseo ", "camino ", "ronda ", "travesia ", "c/ "],
    "strasse apart": [" strasse", " straße", " str.", " gasse", " weg ", " allee ", " platz ", " ufer ", " ring ", " damm ", " steig "],
    "via": ["via ", "viale ", "piazza ", "corso ", "rua ", "largo ", "praca "],
    "straat": ["straat ", "laan ", "gracht ", "plein ", "gatan ", "vagen ", "gade ", "vej "],
    "ulica": ["ul. ", "ulica "],
    "box": ["po box", "p.o. box", "p. o. box", "postfach", "apartado"],
    "after": ["my real name is ", "thanks to ", "someone: ", "author=", "brother ", "reported by ", "ask for ", "i told ", "best,\n", "regards,\n", "merci a ", "frere ", "signale par ", "cordialement,\n", "gracias a ", "hermano ", "avisado por ", "saludo,\n", "danke an ", "bruder ", "gemeldet von ", "grusse\n", "my name is "],
    "before": [" lives at ", " wohnt ", " vive en ", " habite "],
}


@lru_cache(maxsize=1)
def _triggers() -> ahocorasick.Automaton:
    """Given names and triggers in one automaton; a word may be both."""
    kinds: dict[str, list[str]] = {n: ["given"] for n in GIVEN_NAMES}
    for kind, words in _TRIGGERS.items():
        for word in words:
            kinds.setdefault(word, []).append(kind)
    automaton = ahocorasick.Automaton()
    for word, of in kinds.items():
        automaton.add_word(word, (len(word), tuple(of)))
    automaton.make_automaton()
    return automaton


_CLUSTER = re.compile(r"\d(?:[ ().\-/]{0,3}\d){5,}")
#: Dates, builds and places on the map: no phone number or identity number is written so.
_COMMON = re.compile(r"20\d\d-[01]\d-[0-3]\d|\d{1,2}\.\d{1,2}\.\d{1,2}\.\d{5}|\d{1,2}\.\d{1,2}(?: / | )\d{1,2}\.\d{1,2}")
#: What may part two numbers of one cluster: dates, builds and places, and signs with a space on either side.
_APART = re.compile(rf"(?<!\d)(?:{_COMMON.pattern})(?!\d)| [/\-] ")
#: Where the number stands beside the word for the way: before it, or behind it.
_REACH = {"address": lambda a, b: (max(0, a - 40), a), "strasse": lambda a, b: (b, b + 5), "rue": lambda a, b: (max(0, a - 8), a), "calle": lambda a, b: (b, b + 50), "strasse apart": lambda a, b: (b, b + 5), "via": lambda a, b: (b, b + 50), "straat": lambda a, b: (b, b + 5), "ulica": lambda a, b: (b, b + 30), "box": lambda a, b: (b, b + 4)}
_PAIR = re.compile(rf"({_SURNAME})(?:,? [^\W\d_]\.)?,? ({_SURNAME})(?: [^\W\d_]\.)?(?![\w@])")
_PAIR_BEFORE = re.compile(rf"(?<![\w@.+-])({_SURNAME})(?: [^\W\d_]\.)?,? ({_SURNAME})(?: [^\W\d_]\.)?$")


_COMPILED = {k: tuple(re.compile(t[k]) for t in (_LABELS, _AFTER, _GAME, _GAME_AFTER)) for k in KINDS}


def _near(places: list[int], before: int, after: int, size: int) -> list[tuple[int, int]]:
    """Stretches of text around places, joined where they touch."""
    out: list[tuple[int, int]] = []
    for p in places:
        low, high = max(0, p - before), min(size, p + after)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _numbers(text: str, low: int, high: int) -> Iterator[re.Match]:
    """Numbers in a stretch, those that run over a sign with spaces and those on either side of one."""
    seen = set()
    cuts = [(m.start(), m.end()) for m in _APART.finditer(text, low, high)]
    pieces = zip([low, *(b for _, b in cuts)], [*(a for a, _ in cuts), high], strict=True) if cuts else ()
    for a, b in ((low, high), *pieces):
        for m in _DIGITS.finditer(text, a, b):
            if m.span() not in seen:
                seen.add(m.span())
                yield m


def candidates(text: str, low: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, form) of every span that may be personal; they overlap freely. Both texts are folded.

    One automaton and one pattern for digits find the places where anything can be; the patterns of the
    kinds then look at the stretches around them only.
    """
    found: list[tuple[str, int, int, int]] = []
    mails: list[int] = []
    streets: dict[str, list[int]] = {kind: [] for kind in _REACH}
    size = len(low)
    for end, (length, kinds) in _triggers().iter(low):
        start, end = end - length + 1, end + 1
        for kind in kinds:
            if kind == "given":
                if (start and (low[start - 1].isalnum() or low[start - 1] in "@._+-'")) or (end < size and (low[end].isalnum() or low[end] in "@_+-'")):
                    continue
                after = _NEXT.match(low, end)
                if after and after[2] not in SMALL_WORDS:
                    found.append(("name", start, after.end(), 0))
                before = _BEFORE.search(low, max(0, start - 60), start) if low[start - 2 : start] == ", " else None
                if before and before[1] not in SMALL_WORDS:
                    found.append(("name", before.start(), end, 1))
            elif kind == "email":
                mails.append(start)
            elif kind in streets:
                if _NUMBER.search(low, *_REACH[kind](start, end)):
                    streets[kind].append(start)
            elif kind == "after":
                m = _PAIR.match(low, end)
                if m and m[1] not in SMALL_WORDS and m[2] not in SMALL_WORDS and m[1] not in TITLES:
                    found.append(("name", m.start(), m.end(), 4 if "," not in m[0] else 1))
            else:
                m = _PAIR_BEFORE.search(low, max(0, start - 60), start)
                if m and m[1] not in SMALL_WORDS and m[2] not in SMALL_WORDS and m[1] not in TITLES:
                    found.append(("name", m.start(), m.end(), 4 if "," not in m[0] else 1))
    for a, b in _near(mails, 90, 120, size):
        for m in _EMAIL.finditer(text, a, b):
            lead = len(m[0]) - len(m[0].lstrip(".-+%"))
            found.append(("email", m.start() + lead, m.end(), 0 if "@" in m[0] else 1))
    for n, kind in enumerate(streets):
        for a, b in _near(streets[kind], 70, 70, size) if streets[kind] else ():
            found += [("address", m.start(), m.end(), n) for m in _ADDRESSES[n].finditer(low, a, b)]
    # one stretch for each cluster, however long, so that no number is cut
    clusters: list[tuple[int, int]] = []
    for m in _CLUSTER.finditer(text):
        if _COMMON.fullmatch(m[0]) is None:
            start, end = max(0, m.start() - 12), min(size, m.end() + 12)
            if clusters and start <= clusters[-1][1]:
                start = clusters.pop()[0]
            clusters.append((start, end))
    for a, b in clusters:
        for m in _numbers(text, a, b):
            # a bracket around the whole number is no part of it, one around an area code is
            found.append(("phone", m.start() + (m[0][0] == "(" and _AREA.match(m[0]) is None), m.end(), 0))
        for n, shape in enumerate(_ID_SHAPES):
            found += [("id_number", m.start(), m.end(), n) for m in shape.finditer(text, a, b)]
    for m in _MIXED.finditer(text):
        if (start := _LETTERS_BEFORE.search(text, max(0, m.start() - 7), m.start())) is not None:
            found.append(("id_number", start.start(), m.end(), len(_ID_SHAPES)))
    at = low.find(". ")
    while at >= 0:
        if at and low[at - 1].isalpha() and (at < 2 or not (low[at - 2].isalnum() or low[at - 2] in "_.'-")):
            m = _INITIAL.match(low, at - 1)
            if m and m[1] not in SMALL_WORDS:
                found.append(("name", m.start(), m.end(), 2))
        at = low.find(". ", at + 2)
    at = low.find(", ")
    while at >= 0:
        if low[at + 3 : at + 4] == "." and low[at + 2].isalpha():
            m = _LAST_INITIAL.search(low, max(0, at - 60), at + 5)
            if m and m[1] not in SMALL_WORDS:
                found.append(("name", m.start(), m.end(), 3))
        at = low.find(", ", at + 2)
    known = {(a, b) for kind, a, b, _ in found if kind == "name"}
    for a, b, form in _shapes(text):
        if (a, b) not in known:
            known.add((a, b))
            found.append(("name", a, b, form))
    return found


_INTERNATIONAL = re.compile(r"\+|00\d\d[ -]")
_PHONE_FORMS = [
    re.compile(p)
    for p in (
        r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]?\d{4}",
        r"(?:\+44 ?(?:\(0\) ?)?|0044[ -]?|0)\d{2,4}[ -]?\d{3,4}[ -]?\d{0,4}(?: ?\d{1,4})*",
        r"(?:\+33 ?|0033 ?|0)(?:\(0\) ?)?\d(?:[ .-]?\d\d){4}",
        r"(?:\+49[ -]?|0049[ -]?|\(?0)\d{2,4}\)?(?: ?[-/ ] ?)\d{3,6}(?: ?\d{1,4})*",
        r"(?:\+34 ?|0034 ?)?[6789]\d{2}(?:[ .-]?\d{2,3}){2,3}",
        r"\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}",
    )
]
_DATE = re.compile(r"(?:19|20)\d\d-\d\d-\d\d|\d{1,2}[./-]\d{1,2}[./-](?:19|20)\d\d")


def features(text: str, low: str, kind: str, start: int, end: int, form: int) -> list[float]:
    """Format and context of one span; the same length for all spans of a kind."""
    label, after, game, game_after = _COMPILED[kind]
    left, right, span, plain = low[max(0, start - 30) : start], low[end : end + 40], text[start:end], low[start:end]
    row = [float(form), float(label.search(left) is not None), float(after.match(right) is not None), float(game.search(left) is not None), float(game_after.match(right) is not None), float(end - start)]
    digits = len(_NUMBER.findall(span))
    before = text[start - 1] if start else "\n"
    row += [float(before in "\n\r"), float(before in "<(\"'"), float(right[:1] in "\n\r" if right else True), float(right[:1] in ".,;:)>")]
    left, wide = low[max(0, start - 45) : start], low[max(0, start - 60) : end + 60]
    row += [float(_CUE[kind].search(left) is not None), float(_PLAY.search(wide) is not None)]
    if kind == "email":
        parts = re.split(r"@|[(\[] ?at ?[)\]]| at ", plain)
        domain = parts[-1]
        row += [float(bool(re.search(r"\.|dot", domain))), float(" " in parts[0].strip()), float(bool(re.search(r"(?:example|test|invalid|com|net|org|de|fr|es|uk|info|io)\W*$", domain))), float(len(parts[0])), float(plain.count(" ")), float(bool(re.search(r"[a-z]{2,}$", domain)))]
    elif kind == "phone":
        row += [float(digits), float(_INTERNATIONAL.match(span) is not None), float(_DATE.search(span) is not None), float(len(re.findall(r"\d+", span))), float("(" in span), float(any(p.fullmatch(span) for p in _PHONE_FORMS)), float(span.isdigit()), float(bool(re.match(r"\d{1,3}\.\d{1,2}\b", span))), float(bool(re.fullmatch(r"\d{3}[- ]\d{2}[- ]\d{4}", span))), float(bool(re.fullmatch(r"[12](?: ?\d\d){3} ?\d{3} ?\d{3} ?\d\d", span))), float(span[0] == "0"), float(bool(re.fullmatch(r"\d+(?:\.\d+){2,}", span))), float(" - " in span or " / " in span), float(_CUE["id_number"].search(left) is not None), float("," in span)]
    elif kind == "id_number":
        row += [float(digits), float(digits + sum(c.isalpha() for c in span)), float(span[0].isdigit()), float(bool(re.search(r"[a-f0-9]{7,}", plain)) and not span.isdigit() and "-" not in span and form not in (1, 2, 3, 4)), float(any(c in span for c in " -.")), float(_CUE["phone"].search(left) is not None), float(span.isupper()), float(len(re.findall(r"\d+", span))), float(bool(re.search(r"[a-z]{3}, $", left))), float(bool(re.search(r"[=#/({]\s*$", left)))]
    elif kind == "address":
        row += [float(digits > 0), float(bool(re.match(r"flat|apt|unit|suite|room", plain))), float(bool(re.match(r"[,\s]*(?:\d{5}|[a-z]{2}\d ?\d[a-z]{2})", right))), float(right[:2] == ", " and right[2:3].isalpha()), float(sum(w[:1].isupper() or w[:1].isdigit() for w in span.split()) / max(1, len(span.split()))), float("old road" in plain or plain.startswith("the ")), float(any(w in SMALL_WORDS for w in plain.split()[1:] if form < 1)), float(len(plain.split())), float(plain.split()[0] in SMALL_WORDS)]
    else:
        words = re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*", span)
        turned = form in (1, 3, 8)
        family = (words[0] if turned else words[-1]) if words else ""
        given = (words[-1] if turned else words[0]) if words else ""
        title = re.search(r"(\w+)\W*$", left)
        small = family.lower()
        row += [float(family[:1].isupper()), float(family.isupper()), float(len(family)), float(any(p.endswith(_ENDINGS) for p in small.split("-"))), float(small.endswith(_GAME_ENDINGS)), float("-" in family), float(title is not None and title[1] in TITLES), float(words[0][:1].isupper() == family[:1].isupper()) if words else 0.0, float(span.islower()), float(bool(re.match(rf" (?:{_WAY_EN})\b", right))), float(re.match(r"\d|\w*\d", left[-3:].strip()) is not None), float(small in SMALL_WORDS or len(small) < 4), float(bool(re.search(r"[.!?] $|^$", left)))]
        # whether a word runs into it: an initial behind a given name is not the start
        row.append(float(left[-1:] == " " and left[-2:-1].isalpha()))
        scores = [likeness(w.lower()) for w in words if len(w) > 1] or [0.0]
        row += [likeness(given.lower()) if len(given) > 1 else 0.0, likeness(family.lower()), min(scores), sum(scores) / len(scores), float(given.lower() in _GIVEN_SET)]
        row += [float(_CUE_AT_END.search(left) is not None), float(_DOES.match(right) is not None), float(len(words)), float(any(w.lower() in _TITLE_SET for w in words)), float(text[max(0, start - 12) : start].isupper() and span.isupper())]
    return row


#: One for each kind, and "shape" for names proposed by their shape.
Models = dict[str, BoostedTrees]
#: In texts at large spans that only look like names are so many times as frequent as in the seed.
_OTHER_NAMES = 12


def _describe(folded: str, low: str) -> list[tuple[tuple[str, int, int, int], str, list[float]]]:
    """Candidates, each with the name of its model and its features."""
    proposed = candidates(folded, low)
    around = _Around(proposed)
    return [(c, "shape", shape_features(folded, low, around, *c[1:])) if c[3] >= 5 and c[0] == "name" else (c, c[0], features(folded, low, *c)) for c in proposed]


@lru_cache(maxsize=1)
def models(sentences: int = 6000, general: int = 6000) -> Models:
    """Trained and calibrated models from at most so many labelled sentences of one seed and texts of the other.

    Of every four texts one is held out to calibrate. Deterministic.
    """
    from quernel.llm.pii_general import labelled_general
    from quernel.llm.pii_seed import labelled

    rows: dict[str, tuple[list, list, list]] = {k: ([], [], []) for k in (*KINDS, "shape")}
    for n, (text, spans) in enumerate([*labelled(sentences), *labelled_general(general)]):
        folded, places = fold(text)
        low = lower(folded)
        true = {(k, s) for k, s in spans}
        for (kind, start, _, _), model, row in _describe(folded, low):
            x, y, held = rows[model]
            x.append(row)
            y.append(float((kind, start if places is None else int(places[start])) in true))
            held.append(n % 4 == 3)
    out = {}
    for kind, (x, y, held) in rows.items():
        a, b, h = np.array(x), np.array(y), np.array(held)
        out[kind] = BoostedTrees(trees=80, depth=4 if kind in ("shape", "id_number") else 3).fit(a[~h], b[~h]).calibrate(a[h], b[h], _OTHER_NAMES if kind == "shape" else 1)
    return out


def lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def find_spans(texts: list[str | None], trained: Models | None = None) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) of the personal information of each text, in order; spans do not overlap."""
    trained = trained or models()
    described: dict[str, tuple[list, list]] = {k: ([], []) for k in trained}
    places: list[np.ndarray | None] = []
    for n, text in enumerate(texts):
        folded, place = fold(text) if text else ("", None)
        places.append(place)
        for c, model, row in _describe(folded, lower(folded)):
            owners, rows = described[model]
            owners.append((n, *c))
            rows.append(row)
    kept: list[list[tuple[float, str, int, int]]] = [[] for _ in texts]
    for name, (owners, rows) in described.items():
        if not rows:
            continue
        model = trained[name]
        for (n, kind, start, end, _), p in zip(owners, model.probability(np.array(rows)).tolist(), strict=True):
            if p >= model.cutoff:
                kept[n].append((p, kind, start, end))
    out: list[list[tuple[str, int, int]]] = []
    for spans, place in zip(kept, places, strict=True):
        chosen: list[tuple[str, int, int]] = []
        # an address inside which a name stands, or a mail address with one, goes before the name
        for _, kind, start, end in sorted(spans, key=lambda s: (s[1] == "name", -s[0], s[2] - s[3], s[2])):
            if all(end <= a or start >= b for _, a, b in chosen):
                chosen.append((kind, start, end))
        chosen.sort(key=lambda s: s[1])
        out.append([(k, int(place[s]), int(place[e - 1]) + 1) if place is not None else (k, s, e) for k, s, e in chosen])
    return out


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] and [NAME] in place of the spans."""
    for kind, start, end in reversed(spans):
        text = f"{text[:start]}[{kind.upper()}]{text[end:]}"
    return text


#: Texts whose candidates are described before one call of the models.
_AT_ONCE = 2000


def find_personal(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, pii_type, start_pos, end_pos (code points from 0) of every find.

    Null and empty texts have none; repeated rows are searched each by itself; rows with a null key are
    kept. No shuffle: tasks search their own rows in Arrow batches with models the driver has trained (some
    ten thousand numbers).
    """
    trained = documents.sparkSession.sparkContext.broadcast(models())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(at, _AT_ONCE)
                keys, spans = part.column(0), find_spans(part.column(1).to_pylist(), trained.value)
                owner = np.repeat(np.arange(len(spans)), [len(s) for s in spans])
                flat = [s for row in spans for s in row]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner)), pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.int32()), pa.array([s[2] for s in flat], pa.int32())], names=[key, "pii_type", "start_pos", "end_pos"])

    rows = documents.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, pii_type string, start_pos int, end_pos int")


def redact_documents(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text of every document, with typed placeholders for the finds; null texts stay null."""
    trained = documents.sparkSession.sparkContext.broadcast(models())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            clean = [redact(t, s) for t, s in zip(texts, find_spans(texts, trained.value), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clean, pa.string())], names=[key, text])

    rows = documents.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, `{text}` string")
