"""Labelled sentences from which the models for personal information are trained.

Sentences are made from templates with slots; slots of personal kinds are labelled with the place
they start at, the other slots are things that look alike and are not personal. Deterministic and
of bounded number.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable

_GIVEN = "Peter Grace Simon Ruth Adam Oliver Laura Nora Daniel Anna Philip James Martin Megan Holly Stella Heike Lukas Bärbel Björn Jörg Matthias Sabine Katrin Uwe Anke Stefan Rémi Luc Thierry Hélène Chantal Gérard François Amélie Maëlle Elena Lucía Joaquín José Begoña Íñigo Inés Raúl Marta Andrés David Emma Paul Julia Karl Sofia Hugo".split()
_HEADS = "Ander Brook Calder Denn Elver Fenn Gald Hart Ingram Jarr Kel Lind Moor Nettin Oster Pren Quill Rost Sand Thorn Ulv Vest Wend Yar Stro Tess Jort Marr Kast Bram Fald Griv Dunf Lurm Hesk Oxl Pell Quess Rausk Harv Nold Tolm Vree".split()
_TAILS = "son sson ovitch ubridge oughby ecott ton ham ley iewick enard amere ingale elline ström strom añez üske erholt ardo érou mann stein feld ner eau ier er".split()
_GAME_FIRST = "Korgul Nerzul Thasmorn Orlwyn Shassa Muthas Velzul Dranash Growyn Aedok Béthas Ulvane Ysrik Zanlôt Ñemorn Quorik Rünash Mugul".split()
_GAME_LAST = "Saltmarrow Hearthgnaw Quillbane Emberlatch Duskwarden Thornwick Palebriar Brasskettle Coldlantern Rustspindle Stonehollow Gritmantle Mirefoot Ashbarrow".split()
_GAME_TITLE = "Captain Elder Sister Foreman Overseer Quartermaster".split()
_TOWNS = "Ambergate Rookfold Kelpmoor Wickerfen Ironbarrow Duskreach".split()
_DOMAINS = "lanternbox tinroof greyfold moorpost saltwire quillmail papermill bluedoor".split()
_ZONES = "example test invalid example.org example.net com net org".split()
_THINGS = "Frostbitten Ledger,Salted Flask,Hollow Compass,Braided Tusk,Gilded Idol".split(",")


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def family(r: random.Random) -> str:
    one = lambda: r.choice(_HEADS) + r.choice(_TAILS)
    return f"{one()}-{one()}" if r.random() < 0.12 else one()


def name(r: random.Random) -> str:
    given, last = r.choice(_GIVEN), family(r)
    middle = f" {r.choice('ABCDEFGHJKLMPRST')}." if r.random() < 0.15 else ""
    kind = r.random()
    text = f"{given}{middle} {last}" if kind < 0.62 else f"{last}, {given}{middle}" if kind < 0.82 else f"{given[0]}. {last}" if kind < 0.97 else f"{last}, {given[0]}."
    case = r.random()
    return text.upper() if case < 0.06 else text.lower() if case < 0.12 else text


def email(r: random.Random) -> str:
    given, last = r.choice(_GIVEN).lower(), family(r).lower().split("-")[0]
    user = r.choice([f"{given}.{last}", f"{last}_{given}", f"{given[0]}{last}", f"{last}{_digits(r, 3)}", f"{given}+quests", f"{r.choice(_HEADS).lower()}{_digits(r, 2)}"])
    host = r.choice(["", "", "", "mail."]) + r.choice(_DOMAINS) + "." + r.choice(_ZONES)
    kind = r.random()
    text = f"{user}@{host}" if kind < 0.75 else f"{user} @ {host}" if kind < 0.8 else f"{user}(at){host}" if kind < 0.85 else f"{user} [at] {host.replace('.', ' [dot] ')}" if kind < 0.93 else f"{user} AT {host.replace('.', ' DOT ')}"
    return text.upper() if r.random() < 0.06 and kind < 0.8 else text


def phone(r: random.Random) -> str:
    d = lambda n: _digits(r, n)
    area = str(r.randint(201, 989))
    line = f"01{d(2)}"
    text = r.choice(
        [f"+1-{area}-555-{line}", f"({area}) 555-{line}", f"{area}-555-{line}", f"{area}.555.{line}", f"{area} 555 {line}", f"+1 {area} 555 {line}", f"1 ({area}) 555{line}"]
        + [f"+44 20 7946 0{d(3)}", f"+44 (0)20 7946 0 {d(3)}", f"+44 (0)7700 900 {d(3)}", f"+44 7700 900{d(3)}", f"01632 960{d(3)}", f"+44 1632 960{d(3)}", f"0044 1632 960{d(3)}", f"+44 (0)1632 960 {d(3)}", f"020 7946 0{d(3)}", f"07700 900{d(3)}"]
        + [f"+33 1 99 00 {d(2)} {d(2)}", f"01 99 00 {d(2)} {d(2)}", f"01.99.00.{d(2)}.{d(2)}", f"0033 1 99 00 {d(2)} {d(2)}"]
        + [f"+49 30 23125 {d(3)}", f"030/23125 {d(3)}", f"(030) 23125 {d(3)}", f"030 - 23125 {d(3)}", f"0049-30-23125 {d(3)}"]
        + [f"+34 6{d(2)} {d(3)} {d(3)}", f"6{d(2)} {d(2)} {d(2)} {d(2)}", f"+34 91{d(1)} {d(2)} {d(2)} {d(2)}"]
    )
    return text.translate({48 + i: chr(0xFF10 + i) for i in range(10)}) if r.random() < 0.04 else text


def id_number(r: random.Random) -> str:
    d = lambda n: _digits(r, n)
    letter = r.choice("ABCDEFGHIJKLMNOPRSTUVWXYZ")
    s = r.choice(["-", " "])
    first = r.choice(["000", "666", f"9{d(2)}"])
    text = r.choice(
        [f"{first}{s}{d(2)}{s}{d(4)}"] * 4
        + [f"QQ{d(6)}C", f"QQ {d(2)} {d(2)} {d(2)} C", f"QQ-{d(2)}-{d(2)}-{d(2)}-A", f"QQ{d(6)}A"]
        + [f"P-00{d(5)}", f"X00{d(5)}", f"XQ 00{d(5)}", f"000{d(6)}", f"000{d(6)}"]
        + [f"L0X0{d(5)}", f"L0X0{d(3)} {d(2)}D", f"l0x0-{d(3)}-{d(2)}", f"L0X0{d(5)}"]
        + [f"0000{d(4)}{letter}", f"00.00{d(4)} {letter}", f"0000{d(4)}-{letter}"]
        + [f"1 {d(2)} {r.randint(1, 12):02d} 99 {d(3)} {d(3)} {d(2)}", f"2{d(2)}{r.randint(1, 12):02d}99{d(3)}{d(3)}{d(2)}"]
    )
    return text


def address(r: random.Random, lang: str) -> str:
    n, zone = r.randint(1, 260), f"00{_digits(r, 3)}"
    if lang == "de":
        street = r.choice(["Mühl", "Linden", "Altsäge", "Brennhof", "Kiesel", "Wollmarkt", "Ziegelgrund", "Rosen"]) + r.choice(["straße", "str.", "gasse", "weg", "allee", "platz"])
        return f"{street} {n}{r.choice(['', '', 'a', ' b'])}, {zone} {r.choice(['Krähenfurt', 'Oberlinnau', 'Nebelheim', 'Grauquell'])}"
    if lang == "fr":
        street = r.choice(["rue", "quai", "impasse", "avenue", "place", "chemin"]) + r.choice([" du Vieux-Four", " des Tisseurs", " de la Grande Ourse", " des Épinettes", " de l'Abbaye"])
        return f"{n}{r.choice(['', ' bis', ','])} {street}, {zone} {r.choice(['Mornebrune', 'Aubéclair', 'Valbrise'])}"
    if lang == "es":
        street = r.choice(["Calle", "C/", "Plaza", "Avenida", "Paseo"]) + r.choice([" del Búho Gris", " de los Telares", " Peñaquebrada", " del Molino Hondo"])
        return f"{street}{r.choice([',', ''])} {n}{r.choice(['', ' bajo', ', 3.º B'])}, {zone} {r.choice(['Torrequieta', 'Villasauce', 'Ribacanto'])}"
    way = r.choice("Street St St. Road Rd Ave Avenue Lane Crescent Drive Close".split())
    street = f"{n} {r.choice(['Harrow Bend', 'N. Tannery', 'Old Cooper', 'West Plover', 'Saltwell', 'Quillmere', 'Maple', 'E. Orchard'])} {way}"
    flat = r.random()
    street = f"Flat {r.randint(1, 20)}, {street}" if flat < 0.25 else f"{street}, Apt {r.randint(1, 20)}{r.choice('ABCD')}" if flat < 0.5 else street
    town = r.choice(["Tallowby", "Brackenport", "Ostwick", "Upper Fenning", "Coldmarsh"])
    zip_code = r.choice([f" ZX{_digits(r, 1)} 0QQ", f", ZZ {zone}", "", f" {zone}"])
    text = f"{street}{r.choice([', ', chr(10)])}{town}{zip_code}"
    return text.lower() if r.random() < 0.04 else text


#: <slot> is personal and labelled, {slot} is not.
_TEMPLATES = {
    "en": [
        "My real name is <name> and my number is <phone>.", "Thanks to <name> for testing!", "I told <name> and <name> about it.", "(reported by <name>, <email>)", "they doxxed someone: <name>, <id_number>",
        "author=<name>; mail=<email>", "Best,\n<name>\n<address>", "<name> lives at <address>.", "my brother <name> found it first.", "Contact: <email> or <phone>", "Mail <email> if the pin is wrong.", "mailto:<email>", "<<email>> wrote:",
        "call me on <phone> after nine", "text <phone>", "ID card <id_number>, tel <phone>", "passport <id_number> was asked for when I recovered the login", "support wanted my SSN, <id_number>, to restore the account", "identity number on file: <id_number>.",
        "Send the printed map to <address>.", "The meetup is at <address>, ask for <name>.", "Best,\n<name>\n<phone>", "Regards,\n<name>\n<email>",
    ],
    "de": ["Tel. <phone>, Personalausweis <id_number>", "<name> wohnt in der <address>.", "Schreibt an <email>, falls der Punkt falsch ist.", "Die Karte bitte an <address> schicken.", "Mein Bruder <name> war schneller.", "gemeldet von <name> (<email>)", "gemeldet von <name> (<phone>)", "Viele Grüße\n<name>\n<address>", "Danke an <name> für den Test!", "Ausweisnummer <id_number> wollte der Support wissen.", "Ruft mich an: <phone>"],
    "fr": ["Appelez le <phone>", "<name> habite au <address>.", "Envoyez la carte au <address>.", "Merci à <name> pour le test !", "Mon frère <name> l'a trouvé avant moi.", "signalé par <name> (<email>)", "signalé par <name> (<phone>)", "Cordialement,\n<name>\n<phone>", "Le support voulait mon numéro : <id_number>", "Écrivez à <email> si le point est faux."],
    "es": ["Llámame al <phone>", "<name> vive en <address>.", "Enviad el mapa a <address>.", "Gracias a <name> por probarlo.", "Mi hermano <name> lo encontró antes.", "avisado por <name> (<phone>)", "avisado por <name> (<email>)", "Un saludo,\n<name>\n<email>", "Soporte me pidió el DNI <id_number>", "Escribid a <email> si el punto está mal."],
}
_OTHERS = [
    "the mailbox quest asks for {number} reputation near {coords}.", "the thorn boar hits for {number} damage see ticket #{number}.", "{game} patrols towards {town} at {coords}.", "the inn on Cooper's Lane in {town}", "{game} sells {thing} at 12 Barrel Row stalls", "along the old road to {town} so skip it.",
    "npc:{game}@{town}", "As of build {build}, {game} is bugged (seen on {date}).", "guid Creature-0-{d4}-{d3}-{d5}-{hex}", "kill count {number} / {number}", "v{build}, id={number}", "(commit {hex})", "send it by in-game mail to {game}.", "passport stamp from {game}", "call for {game} three times",
    "The vendor {game} gives 25g 33s 38c near [{coords}].", "{given} already said that.", "cc @{nick} and ask {nick}.", "{given} and I found the {thing}.", "Ask {given} about the {thing}.", "https://quests.example/q/{d3}?tab=35#c", "Step 12: go to {coords} and wait {d3} seconds.", "- [{build}] fixed spawn of {game} @ {coords}",
    "tower 30, second floor of {town}", "[url=/npc/{d3}]{game}[/url]", "Grace period of 30 days.", "Since {date} the follow-up to The Keys of {town} was moved in build {build}.", "phase 5, wing B. The crate is empty.", "{given} is not a quest. A. The second option is better.", "ask {game} about Letters from {town}", '"{game} is not to be trusted," says the reef crawler.', "quest 2-1 of 4, {d3}-{d4} kills",
    "100 Gold Way stalls in {town}", "I walked 3 miles on the road to {town}", "5 of 12 people in the square at {town}", "{coords} / 41.2 on {date}", "Seit Build {build} steht {game} im Keller.", "Ab Stufe 51 liegt {thing} am Weg 3.", "Au niveau 40, le gardien de {town} reste en place 12.", "Con nivel 12, el camino a {town} está cerrado.", "id {number}, build {build}",
]
_SLOT = re.compile(r"<(name|email|phone|id_number|address)>|\{(\w+)\}")


def _plain(r: random.Random) -> dict[str, Callable[[], str]]:
    return {
        "number": lambda: r.choice([_digits(r, r.randint(5, 10)).lstrip("0") or "7", f"{r.randint(1, 99)},{_digits(r, 3)}", _digits(r, 9), _digits(r, 10)]),
        "coords": lambda: r.choice([f"{r.randint(1, 99)}.{_digits(r, 1)}, {r.randint(1, 99)}.{_digits(r, 1)}", f"({r.randint(1, 99)}, {r.randint(1, 99)})", f"{r.randint(10, 99)}.{_digits(r, 2)} / {r.randint(10, 99)}.{_digits(r, 2)}", f"{r.randint(1, 99)}.{_digits(r, 1)} {r.randint(1, 99)}.{_digits(r, 1)}"]),
        "build": lambda: f"{r.randint(0, 3)}.{r.randint(0, 60)}.{r.randint(0, 9)}.{r.randint(15000, 79999)}",
        "date": lambda: f"2024-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}",
        "hex": lambda: "".join(r.choice("0123456789ABCDEF") for _ in range(10)) if r.random() < 0.5 else "".join(r.choice("0123456789abcdef") for _ in range(r.choice([7, 12]))),
        "game": lambda: (r.choice(_GAME_TITLE) + " " if r.random() < 0.5 else "") + f"{r.choice(_GAME_FIRST)} {r.choice(_GAME_LAST)}",
        "town": lambda: r.choice(_TOWNS),
        "thing": lambda: r.choice(_THINGS),
        "given": lambda: r.choice(_GIVEN),
        "nick": lambda: r.choice(_HEADS).lower() + r.choice(["xx", "_alt", "hunter", ""]) + _digits(r, 3),
        "d3": lambda: _digits(r, 3),
        "d4": lambda: _digits(r, 4),
        "d5": lambda: _digits(r, 5),
    }


def labelled(sentences: int, seed: int = 7) -> list[tuple[str, list[tuple[str, int]]]]:
    """At most so many texts, each with (kind, start) of what is personal in it."""
    r = random.Random(seed)
    plain = _plain(r)
    out = []
    for _ in range(sentences // 3):
        lang = r.choice(["en", "en", "en", "de", "fr", "es"])
        parts = [r.choice(_OTHERS), r.choice(_TEMPLATES[lang]), r.choice(_OTHERS)]
        r.shuffle(parts)
        text, spans = "", []
        for part in parts:
            text += r.choice(["", "\n", " ", "\n "]) if not text else r.choice([" ", "\n", "  "])
            at = 0
            for m in _SLOT.finditer(part):
                text += part[at : m.start()]
                at = m.end()
                if m[1]:
                    spans.append((m[1], len(text)))
                    make = {"name": name, "email": email, "phone": phone, "id_number": id_number}.get(m[1])
                    text += make(r) if make else address(r, lang)
                else:
                    text += plain[m[2]]()
            text += part[at:]
        out.append((text, spans))
    return out


def personal_words() -> list[str]:
    """Family names as the sentences have them, of another seed."""
    r = random.Random(5)
    return [w for _ in range(150) for w in family(r).split("-")]


def other_words() -> list[str]:
    sentences = [w for t in [*_OTHERS, *(t for ts in _TEMPLATES.values() for t in ts)] for w in re.findall(r"(?<![<{\w])[^\W\d_a-z][^\W\d_]+", t)]
    return sentences + _GAME_FIRST + _GAME_LAST + _GAME_TITLE + _TOWNS + [w for t in _THINGS for w in t.split()]
