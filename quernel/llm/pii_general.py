"""Labelled sentences of letters, support, news, travel and chat, with names, addresses and numbers of many countries.

They stand beside the sentences of pii_seed, so that the models learn from form and context in general.
Deterministic and of bounded number. The pools of likeness() are others than those of the sentences: the
score of a name in the sentences is that of a name the score was not fitted to.
"""

from __future__ import annotations

import random
import re

# Given and family names of many origins, for the sentences.
_GIVEN = """Priyanka Arjun Wei Mei Hiroshi Yuki Minjun Seoyeon Thanh Linh Ahmed Layla Mehmet Elif Kwame Amara Ivan Svetlana Pawel Agnieszka Jiri Zuzana Laszlo Eszter Giorgos Eleni
Luca Chiara Joao Beatriz Sander Femke Lars Ingeborg Aino Mikko Sean Niamh Owen Bethan Marcus Hannah Tobias Greta Mathieu Sandrine Ignacio Rosario Deepak Nasrin Omar Hadiza
Stephen Valerie Gareth Phoebe Jean-Luc Anne-Marie Karl-Heinz Mary-Ann Nikolai Tatiana Rajesh Sunita Kenji Haruka Abdul Salma Emre Ayse""".split()
_FAMILY = """Krishnan Mukherjee Zhang Huang Nakamura Fujita Park Choi Pham Vo Hassan Khoury Yilmaz Demir Mensah Okonkwo Petrov Kuznetsova Kowalczyk Zielinski Dvorak Novotna Horvath Szabo Papadakis
Bianchi Ferrara Pereira Carvalho Jansen Dijkstra Lindqvist Haugen Virtanen Nieminen Gallagher Doyle Pritchard Griffiths Thompson Baxter Schneider Lehmann Lefebvre Moreau Navarro Iglesias Reddy Chaudhry
Farouk Bello Whitaker Hargreaves Fletcher Ng Wu Li O'Connor D'Angelo McAllister Ivanov Sokolova Banerjee Tanaka Rahman Celik Marchetti Oliveira""".split()
# Other names of many origins, for the likeness score.
_SCORE_GIVEN = """Ananya Vikram Xiu Jun Takeshi Sakura Jihoon Hana Duc Huong Yusuf Mariam Murat Zeynep Kofi Ngozi Sergei Olga Tomasz Katarzyna Petr Lenka Istvan Judit Nikos Sofia Matteo Giulia Pedro Ines Pieter Anneke
Sven Astrid Jukka Kaisa Patrick Siobhan Rhys Carys Edward Lucy Florian Ulrike Antoine Celine Fernando Lucia Sanjay Parveen Tariq Aisha Michael Rebecca Alistair Imogen Boris Irina Suresh Lakshmi Ryo Ayumi Karim Zainab Burak Selin
Rohan Kavita Neha Amit Li Xin Fang Qiang Daisuke Naoko Emi Sungho Eunji Bao Trang Mohammed Fatima Khalid Noor Ali Hasan Kemal Fatma Yaw Abena Chidi Ifeoma Dmitri Natalya Yuri Anastasia Marek Ewa Vaclav Jana Gabor Katalin Dimitris Maria Alessandro Francesca Paolo
Thiago Mariana Joris Marieke Erik Karin Antti Liam Aoife Gwen Rhiannon Henry Charlotte Leonie Moritz Jerome Margaux Alejandra Esteban Harpreet Gurdeep Bilal Amina Adewale Samir Leila Ephraim Miriam Levi Tamar""".split()
_SCORE_FAMILY = """Sharma Gupta Iyer Chen Liu Wang Sato Yamamoto Kobayashi Kim Lee Nguyen Tran Al-Masri Haddad Ozturk Kaya Asante Adeyemi Eze Volkova Smirnov Orlov Nowicki Wisniewska Svoboda Prochazka Nagy Kovacs Pappas Georgiou Rossi Romano
Colombo Silva Fernandes Costa Bakker Visser Eriksson Johansen Korhonen Makinen Murphy Byrne Davies Evans Harrison Bennett Walker Schmidt Hoffmann Wagner Weber Dubois Laurent Girard Garcia Romero Vargas Singh Kapoor Malik Hussain
Abubakar Ashworth Ellington Bradshaw Cho Ma Xu O'Neill DiMarco MacLeod Popov Federova Das Suzuki Islam Aydin Conti Santos
Desai Patel Rao Joshi Zhao Lin Yang Zhou Suzuki Watanabe Takahashi Kang Jung Bui Dang Le Al-Farsi Mansour Nasser Arslan Polat Boateng Owusu Obi Chukwu Pavlov Morozova Lebedev Kaminski Lewandowska Cerny Kral Toth Varga Nikolaidis Russo Esposito Ricci
Almeida Ribeiro de Vries Mulder Larsson Nilsson Olsen Koskinen O'Sullivan Kavanagh Jones Roberts Clarke Turner Fischer Becker Krause Bernard Fontaine Mercier Torres Molina Herrera Kaur Gill Qureshi Siddiqui Adebayo Cohen Levy Friedman Mahmoud Saleh""".split()
# Words with a capital that are no names of persons.
_OTHER_WORDS = """Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December Yesterday Today Tomorrow Please Thanks Hello Dear Regards
London Paris Berlin Madrid Rome Vienna Lisbon Warsaw Tokyo Chicago Boston Denver Texas France Germany Spain Italy Japan China India Europe America England Scotland The This That These Those There Here When Where While After Before
Meanwhile However Although Because Since Until Both Each Every Some Many Most Another Our Your Their His Her Its We You They She He Company Office Hotel Airport Station University College School Hospital Bank Museum Library Theatre Market
Street Avenue Bridge River Lake Mountain Park Garden Castle Tower Harbour Order Invoice Account Customer Service Support Manager Director President Minister Doctor Professor Captain Engine Version Update Windows Android Google Amazon Server
Quest Dungeon Raid Vendor Guard Boss Level Ledger Flask Compass Idol Tusk Sword Shield Armor Staff Potion Scroll Dragon Wolf Spider Golem Imp Boar Kobold Murloc Harpy Warden Keeper Hunter Priest Mage Rogue Druid Shaman""".split()
_ROLES = "customer client patient tenant passenger colleague neighbour teacher lawyer accountant landlord nurse witness applicant driver friend aunt uncle grandfather roommate supplier".split()
_PLACES = ["Blackrock Spire", "Crystal Lake", "Golden Gate Bridge", "Silver Ridge Mine", "Stone Harbor", "Royal Albert Hall", "Red Square", "New York", "San Francisco", "Iron Forge", "Frozen Throne", "Twilight Grove", "Baker Hall", "King Street Station", "Lake Placid", "Saint Helena"]
_FIRMS = ["Harper Collins", "General Electric", "Deutsche Bank", "Morgan Stanley", "Royal Mail", "British Airways", "Stack Overflow", "Visual Studio", "Open Source Initiative", "Acme Logistics", "North Star Shipping", "Blue Ocean Foods"]
_TITLES = "Captain Lord Lady King Queen Commander Warlord Archmage Overlord Elder Sister Foreman".split()
_MADE_UP = ["Zul", "Thra", "Gorn", "Mok", "Vex", "Xar", "Ysh", "Drak", "Kel", "Nath", "Orm", "Shal"], ["gar", "zoth", "mora", "thas", "nak", "rion", "dus", "wyn", "gul", "vash"], ["Bone", "Storm", "Iron", "Shadow", "Moon", "Blood", "Frost", "Thunder", "Ash", "Grim"], ["crusher", "song", "hand", "weaver", "rage", "fang", "mane", "hoof", "whisper", "blade"]

_COMPOUND = "Stone Gold Silver Dusk Dawn Ember Brass Salt Thorn Raven Wolf Mire Grit Cold Pale Rust Quill Hearth Ash Bright Deep Dark High Red Black White Iron Frost Moon Star Oak Copper Mud".split(), "hollow fall gate reach fold marrow briar latch mantle barrow kettle lantern spindle warden fen shelf watch moor ridge wood field stone water brook crest bane claw beard foot wick horn helm tail".split()
_ITEM = "Rusty Broken Ancient Gilded Cracked Woven Heavy Torn Shining Hidden Lost Cursed Blessed Burnt Empty Polished Tattered Sealed Silent Frozen Bitter Hollow Worn Odd Plain Sturdy Faded Twisted Jagged Humming Nameless Sunken Velvet Painted".split(), "Key Lantern Crown Map Letter Ring Hammer Cup Chain Bell Drum Cloak Bow Horn Mirror Candle Pouch Anvil Scale Claw Hide Feather Tome Rope Hook Bucket Saddle Bridle Signet Censer Bellows Spear Helm Coin Basket Relic Debt Silence Night".split()


def compound(r: random.Random) -> str:
    return _pick(r, _COMPOUND[0]) + _pick(r, _COMPOUND[1])


def item(r: random.Random) -> str:
    name = f"{_pick(r, _ITEM[0])} {_pick(r, _ITEM[1])}"
    kind = r.random()
    return name if kind < 0.7 else f"The {_pick(r, _ITEM[1])} of {compound(r)}" if kind < 0.85 else f"{name} of the {_pick(r, _COMPOUND[0])} {_pick(r, _ITEM[1])}"


def spoken(r: random.Random) -> str:
    """A made-up given name."""
    on, vowel, off = "b br d dr f g gr h j k kh l m n r s sh t th thr v vr x y z zh".split(), "a e i o u aa ae ia ô ü é û".split(), "k l m n r s sh th x z g d nd rk".split()
    parts = [_pick(r, on) + _pick(r, vowel) + (_pick(r, off) if r.random() < 0.5 else "") for _ in range(r.choice([2, 2, 3]))]
    return "".join(parts).capitalize()


_PARTICLES = ["van", "van der", "de", "de la", "von", "del", "di", "dos", "bin", "Al"]


def _pick(r: random.Random, items: list[str]) -> str:
    return items[r.randrange(len(items))]


def person(r: random.Random) -> str:
    given, last = _pick(r, _GIVEN), _pick(r, _FAMILY)
    kind = r.random()
    if kind < 0.1:
        last = f"{_pick(r, _PARTICLES)} {last}"
    elif kind < 0.15:
        last = f"{last}-{_pick(r, _FAMILY)}"
    elif kind < 0.22:
        given = f"{given} {_pick(r, _GIVEN)}"
    elif kind < 0.28:
        given = f"{given} {chr(65 + r.randrange(26))}."
    elif kind < 0.36:
        given = f"{given[0]}."
    text = f"{last}, {given}" if r.random() < 0.08 else f"{given} {last}"
    return text.upper() if r.random() < 0.03 else text


def character(r: random.Random) -> str:
    a, b, c, d = (_pick(r, x) for x in _MADE_UP)
    if r.random() < 0.6:
        title = f"{_pick(r, _TITLES)} " if r.random() < 0.4 else ""
        return f"{title}{spoken(r)} {compound(r)}"
    kind = r.random()
    name = f"{a}{b} {c}{d}" if kind < 0.7 else f"{_pick(r, _TITLES)} {a}{b}" if kind < 0.85 else f"{_pick(r, _TITLES)} {_pick(r, _GIVEN)} {c}{d}"
    return f"{_pick(r, _TITLES)} {name}" if kind < 0.25 else name


def _n(r: random.Random, digits: int) -> str:
    return "".join(str(r.randrange(10)) for _ in range(digits))


def mail(r: random.Random) -> str:
    user = _pick(r, [f"{_pick(r, _GIVEN)}.{_pick(r, _FAMILY)}", f"{_pick(r, _FAMILY)}{_n(r, 2)}", f"info-{_pick(r, _FAMILY)}", f"{_pick(r, _GIVEN)}_{_n(r, 4)}"]).lower().replace("'", "")
    host = _pick(r, ["gmail.com", "outlook.com", "post.example.org", "uni-wien.ac.at", "firma.de", "orange.fr", "correo.es", "mail.co.uk", "company.io", "libero.it"])
    return _pick(r, [f"{user}@{host}"] * 6 + [f"{user} (at) {host}", f"{user}[at]{host.replace('.', '[dot]')}"])


def number(r: random.Random) -> str:
    n = lambda d: _n(r, d)
    forms = [f"+44 {n(2)} {n(4)} {n(4)}", f"+44 7{n(3)} {n(6)}", f"0{n(4)} {n(6)}", f"({n(3)}) {n(3)}-{n(4)}", f"{n(3)}-{n(3)}-{n(4)}", f"+1 {n(3)} {n(3)} {n(4)}", f"+49 {n(3)} {n(7)}", f"0{n(3)} {n(7)}", f"0{n(2)}/{n(6)}"]
    forms += [f"+33 {n(1)} {n(2)} {n(2)} {n(2)} {n(2)}", f"0{n(1)} {n(2)} {n(2)} {n(2)} {n(2)}", f"+34 {n(3)} {n(2)} {n(2)} {n(2)}", f"+39 0{n(1)} {n(4)} {n(4)}", f"+48 {n(3)} {n(3)} {n(3)}", f"+91 {n(5)} {n(5)}", f"+31 6 {n(8)}", f"+41 {n(2)} {n(3)} {n(2)} {n(2)}", f"00{n(2)} {n(3)} {n(6)}"]
    return _pick(r, forms)


def identity(r: random.Random) -> str:
    n = lambda d: _n(r, d)
    c = lambda k: "".join(chr(65 + r.randrange(26)) for _ in range(k))
    forms = [f"{n(3)}-{n(2)}-{n(4)}", f"{n(3)} {n(3)} {n(4)}", f"{c(2)} {n(2)} {n(2)} {n(2)} {_pick(r, list('ABCD'))}", f"{n(8)}{c(1)}", f"{c(1)}{n(7)}{c(1)}", f"{c(1)}{n(8)}", f"{c(2)}{n(7)}", f"{n(2)} {n(3)} {n(3)} {n(3)}", f"{n(4)} {n(4)} {n(4)}", f"{n(11)}", f"{n(9)}"]
    forms += [f"{c(6)}{n(2)}{c(1)}{n(2)}{c(1)}{n(3)}{c(1)}", f"{n(6)}-{n(4)}", f"{n(6)}{_pick(r, list('+-A'))}{n(3)}{c(1)}", f"{c(5)}{n(6)}{c(2)}{n(1)}{c(2)}"]
    return _pick(r, forms)


#: What numbers are said to be, before identity().
_ID_WORDS = ["NHS number", "National Insurance number", "passport number", "passport no.", "driving licence", "driver's license number", "tax ID", "Steuer-ID", "Sozialversicherungsnummer", "codice fiscale", "Aadhaar", "PESEL", "BSN", "personnummer", "SSN", "social security number", "ID card number", "numéro de sécurité sociale", "carte d'identité n°", "NIE", "DNI", "Reisepass Nr.", "Ausweis-Nr.", "identity card"]


def place(r: random.Random) -> str:
    n, w = str(r.randint(1, 240)), lambda: _pick(r, ["Rosen", "Haupt", "Kirch", "Garten", "Schiller", "Mozart", "Wiesen", "Bahnhof"])
    words = lambda: _pick(r, ["Oak", "Church", "Victoria", "Mill", "Elm Park", "Station", "High", "Queen's", "Cedar Hill", "Lower Marsh", "Northfield", "Albert"])
    romance = lambda: _pick(r, ["Garibaldi", "Roma", "della Repubblica", "Dante Alighieri", "San Marco", "das Flores", "da Liberdade", "Augusta", "del Sol", "Mayor", "Cervantes", "de los Reyes", "Victor Hugo", "de Rivoli", "des Lilas", "du Moulin"])
    zip_code = _pick(r, ["", f", {_n(r, 5)} {_pick(r, ['Mailand', 'Porto', 'Leiden', 'Graz', 'Lille', 'Leeds', 'Austin'])}", f", {_pick(r, ['Leeds', 'Austin', 'Bristol', 'Dover'])}", f", {_n(r, 4)} {_pick(r, ['AB Delft', 'Wien', 'Bern'])}"])
    forms = [f"{n} {words()} {_pick(r, 'Street Road Avenue Lane Drive Close Way Court Terrace Square St Rd Ave'.split())}"] * 4
    forms += [f"{w()}{_pick(r, 'straße str. weg gasse allee platz'.split())} {n}", f"{_pick(r, ['Berliner', 'Lange', 'Alte', 'Münchner', 'Neue'])} {_pick(r, ['Straße', 'Gasse', 'Allee', 'Str.'])} {n}"]
    forms += [f"{_pick(r, ['Via', 'Viale', 'Piazza', 'Corso', 'Rua', 'Avenida', 'Calle', 'Paseo', 'Largo'])} {romance()}{_pick(r, [' ', ', '])}{n}", f"{n} {_pick(r, ['rue', 'avenue', 'boulevard', 'place'])} {romance()}"]
    forms += [f"{_pick(r, ['Kerk', 'Dorp', 'Prinsen', 'Molen'])}{_pick(r, ['straat', 'laan', 'gracht', 'plein'])} {n}", f"{_pick(r, ['Stor', 'Kungs', 'Strand', 'Skole'])}{_pick(r, ['gatan', 'vägen', 'gade', 'vej'])} {n}", f"ul. {_pick(r, ['Długa', 'Polna', 'Krakowska', 'Mickiewicza'])} {n}", f"{_pick(r, ['PO Box', 'P.O. Box', 'Postfach'])} {_n(r, 4)}"]
    return _pick(r, forms) + zip_code


#: <slot> is personal and labelled, {slot} is not.
_TEXTS = [
    "Please speak with <name> about the contract.", "Yesterday <name> sent the package to <name>.", "Call <name> on <phone>.", "Signed: <name>", "{Role}: <name>", "My doctor is <name>, she is great.", "Dear <name>, your order has shipped.", "Hi <name>,", "I met <name> and <name> at the airport.",
    "<name> called again this morning.", "According to <name>, the meeting was moved.", "The {role} <name> paid on {day}.", "Mr. <name> will attend.", "Frau <name> hat angerufen.", "Herr <name> wohnt jetzt in der <address>.", "Mme <name> a confirmé le rendez-vous.", "El señor <name> vive en <address>.", "La signora <name> abita in <address>.",
    "Kind regards,\n<name>\n<phone>", "Mit freundlichen Grüßen\n<name>", "Cordialement,\n<name>", "Saludos,\n<name>", "From: <name> <<email>>", "To: <email>", "You can reach me at <email> or <phone>.", "my email is <email>", "Name: <name>\nAddress: <address>\nPhone: <phone>", "Contact person: <name>, tel. <phone>",
    "I moved to <address> last year.", "Deliver it to <address>, please.", "Our new address is <address>.", "She lives at <address> with her sister.", "Treffpunkt ist <address>.", "We met at <address> on {day}.", "The package for <name> goes to <address>.", "ship everything to <address>", "L'adresse est <address>.", "Mi dirección es <address>.", "Abito in <address>.",
    "My {idword} is <id_number>.", "{idword}: <id_number>", "His {idword} <id_number> was on the form.", "They asked for my {idword} (<id_number>) again.", "{idword} <id_number>, born {day}", "phone: <phone>", "Mobile <phone>, evenings only", "Telefon: <phone>", "Tél. <phone>", "WhatsApp <phone>", "ring me on <phone> tomorrow", "fax <phone>",
    "ID card <id_number>, tel <phone>", "tel <phone>, passport <id_number>", "{idword} <id_number>, phone <phone>", "<name>, <id_number>", "{Role}: <name>, {idword} <id_number>, <phone>", "they posted <name>, <id_number>", "<name> (<phone>)", "<name> <<email>>", "<name>, <address>", "{Word} {Word} <name> wrote.", "{Word} <name> is here.", "my {role} <name>", "the {role}, <name>, agreed", "is <name> your {role}?", "for <name>", "to <name>", "<name>, {role}", "I am <name>.", "This is <name>.", "with <name> and <name>", "<name> / <name>", "<name>; <name>", "- <name>",
    "{day} <name> and her {role} <name> left.", "<name> wrote the report, <name> checked it.", "Thanks, <name>!", "cc: <name>", "written by <name>", "{Role} <name> said no.", "My {role} is called <name>.", "The letter was from <name>.", "we hired <name> as a {role}", "<name>'s car is outside.", "Is <name> in today?", "Ask <name> for the key.", "mit <name> gesprochen", "avec <name> hier soir", "con <name> ayer",
]
_PLAIN = [
    "The quest giver {character} stands near {place}.", "{character} drops the {Word} {Word} at level 40.", "Kill {character} and loot the chest.", "{character} patrols {place}.", "We flew to {place} on {day}.", "{firm} opened an office in {place}.", "{Word} {Word} is closed on {day}.", "Order {long} was shipped on {day}.", "Ticket #{long} is closed.",
    "Version {v} of {firm} is out.", "It costs {long} gold.", "{character} sells the {Word} {Word}.", "The {Word} {Word} of {place}", "Tracking number {long}", "Order number: {spaced}", "Invoice {spaced} of {day}", "In {year} the {Word} {Word} was built.", "{Word} {Word} and {Word} {Word}", "Both {character} and {character} spawn at 45.2, 61.8.", "Talk to {character} in {place}.",
    "{day} was fine. {Word} {Word} again.", "Walk down the street for 20 minutes.", "Level 12 in 3 days", "12 wolves on the road", "Take the road to {place} and wait 30 seconds.", "5 of 10 guards on the square", "Build {v} fixed it.", "population {spaced}", "score {long}:{long}", "{character} the Unbroken", "guild of {character}", "Serial no. {long}", "ISBN {isbn}", "at {coords}", "{Word} Street Blues is a song.", "Via email only, 3 times", "{character} says hello.", "boss {character} hits for {long}",
    "Bring me 8 pieces of {item}.", "{item} is unique.", "Because {item} is unique, {character} keeps it.", "the {item} asks for {item}", "- {item} in {place}: requires level 12", "He sells {item}, {item} and {item}.", "[{item}]", "## {place}", "Note that the rare called {character} can be skipped.", "{character} gives {item}", "The cellar has {item}", "\"{character} is not to be trusted,\" says the boar.",
    "Der Händler {character} verlangt {item}.", "Nach Build {v} steht {character} hinter der Mühle.", "Viele Gruppen zählen nicht.", "Bringt {item} zu {character}.", "Le gardien {character} réclame {item}.", "Après la mise à jour, {character} reste derrière la cascade.", "El jefe {character} pide {item}.", "Con nivel 12, {character} aparece en {place}.", "Ab Stufe {year} liegt {item} am Ufer.", "Since {day} {item} was moved to {place}.",
    "I was sent by {character} to {place}.", "a letter from {character}", "with {character} and {item}", "ask {character} about {item}", "call {character} three times", "the vendor named {character}", "Once {character} despawns, wait.", "When {character} dies, loot {item}.", "{given} already said that.", "{given} and {given} found {item}.", "{given} got {item} from {character}.", "cc @{nick}", "thanks {nick}", "by {nick} on {day}", "npc:{character}@{place}", "{character} - [{v}]", "{character} @ 12.4, 56.7",
    "item={item}; n={long}", "title={item} | zone={place}", '["name"] = "{item}", ["id"] = {long}', "id = {long}, parent = {long}", "questID = {nine}", "{ [{nine}] = true }", "map {place}, floor 2", "Turn in at {place}, {item} first.", "In {place}, {character} and {character} fight.", "{item} drops from {character}.", "Talk to {character}, {item} in hand.", "What is {item} for?", "{character}, {item}, {place}", "{place} {place} {item}",
    "The {Word} of {place} opens.", "Saga of {character}", "{Word} {item}", "Late at night {character} walks to {place}.", "{character} wants {item} before {day}.", "Patch {v}: {character} no longer drops {item}.", "{character} is bugged.", "After {day} {character} was moved.", "{item}!", "{place} is nice in {Word}.", "{character} from {place} {Word} wants {item}", "IN {place} {Word} WAITS {character}", "by {place} which {character} took", "from {item} to {place}", "by {Word} {Word}", "with {Word} {item}", "called {item}", "Dear {Role}", "Hello {Word} {Word}", "{day} {Word}, {Word} {item}.",
    "{Adverb}, {character} waits.", "{Adverb}, {item} drops here.", "{Adverb}, {given} found {item}.", "bring the {item}", "the {item} is unique", "l'objet {item} tombe", "el objeto {item} cae", "der Gegenstand {item} liegt", "so bring the {item}.", "TODO {Adverb}, {character}", "{Adverb} {Word}", "32 Allee um die Mühle", "90 Allee gegen {item}", "{Noun}, {Noun} durch {item}", "die {Noun} {Noun} um {item}", "{Noun} gegen {Noun}",
]
_SLOT = re.compile(r"<(name|email|phone|id_number|address)>|\{(\w+)\}")


def _other(r: random.Random, slot: str) -> str:
    if slot == "character":
        return character(r)
    if slot == "place":
        return _pick(r, _PLACES) if r.random() < 0.5 else compound(r)
    if slot == "item":
        return item(r)
    if slot == "nick":
        return _pick(r, _COMPOUND[1]) + _n(r, r.randint(0, 3))
    if slot == "given":
        return _pick(r, _GIVEN)
    if slot == "firm":
        return _pick(r, _FIRMS)
    if slot in ("role", "Role"):
        role = _pick(r, _ROLES)
        return role.capitalize() if slot == "Role" else role
    if slot == "Word":
        return _pick(r, _OTHER_WORDS)
    if slot == "idword":
        return _pick(r, _ID_WORDS)
    if slot == "day":
        return _pick(r, [*_OTHER_WORDS[:7], f"{r.randint(1, 28)} {_pick(r, _OTHER_WORDS[7:19])} {r.randint(1950, 2024)}", f"{r.randint(1950, 2024)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", f"{r.randint(1, 28)}/{r.randint(1, 12)}/{r.randint(1950, 2024)}"])
    if slot == "year":
        return str(r.randint(1800, 2024))
    if slot == "v":
        return f"{r.randint(0, 9)}.{r.randint(0, 30)}.{r.randint(0, 9)}.{_n(r, 5)}"
    if slot == "coords":
        return f"{r.randint(1, 99)}.{_n(r, 1)}, {r.randint(1, 99)}.{_n(r, 1)}"
    if slot == "Adverb":
        return _pick(r, "Sadly Luckily Usually Sometimes Suddenly Finally Honestly Curiously Oddly Malheureusement Heureusement Curieusement Normalement Generalmente Normalmente Desafortunadamente Leider Danach Trotzdem Außerdem Zuletzt However Instead Otherwise".split())
    if slot == "Noun":
        return _pick(r, "Wiese Kirche Brücke Mauer Kammer Kanne Laterne Glocke Schmiede Klinge Kette Truhe Wolke Eiche Quelle Küche Stube Allee Scheune Insel".split())
    if slot == "nine":
        return str(r.randint(1, 9)) + _n(r, 8)
    if slot == "isbn":
        return f"978-{_n(r, 1)}-{_n(r, 4)}-{_n(r, 4)}-{_n(r, 1)}"
    if slot == "spaced":
        return _pick(r, [f"{r.randint(1, 9)},{_n(r, 3)},{_n(r, 3)}", f"{_n(r, 4)}-{_n(r, 6)}", f"{r.randint(1, 9)} {_n(r, 3)} {_n(r, 3)}", f"{_n(r, 3)}.{_n(r, 6)}"])
    return str(r.randint(1, 9)) + _n(r, r.randint(3, 10))


_MAKE = {"name": person, "email": mail, "phone": number, "id_number": identity, "address": place}


def labelled_general(texts: int, seed: int = 11) -> list[tuple[str, list[tuple[str, int]]]]:
    """So many texts of four sentences, each with (kind, start) of what is personal in it."""
    r, out = random.Random(seed), []
    for _ in range(texts):
        parts = [_pick(r, _TEXTS), _pick(r, _PLAIN), _pick(r, _PLAIN), _pick(r, _TEXTS if r.random() < 0.4 else _PLAIN)]
        r.shuffle(parts)
        text, spans = "", []
        for part in parts:
            text += _pick(r, [" ", "\n", " "]) if text else ""
            begins, at = len(text), 0
            for m in _SLOT.finditer(part):
                text += part[at : m.start()]
                at = m.end()
                if m[1]:
                    spans.append((m[1], len(text)))
                    text += _MAKE[m[1]](r)
                else:
                    text += _other(r, m[2])
            text += part[at:]
            if "<" not in part and r.random() < 0.08:  # shouted, without names
                text = text[:begins] + text[begins:].upper()
        out.append((text, spans))
    return out


def score_words() -> tuple[list[str], list[str]]:
    """Words that are parts of names of persons, and words that are not."""
    r = random.Random(3)
    made = [w for _ in range(400) for w in [*character(r).split(), *item(r).split()]]
    sentences = [w for t in _TEXTS + _PLAIN for w in re.findall(r"(?<![<{\w])[^\W\d_a-z][^\W\d_]+", t)]
    return _SCORE_GIVEN + _SCORE_FAMILY, sentences + [w.capitalize() for w in _ROLES] + _OTHER_WORDS + [w for p in _PLACES + _FIRMS for w in p.split()] + made
