"""Sentences with labels, written apart from both seeds: other names, numbers, places and phrasings. <kind|text> is personal."""

SENTENCES = """
Yesterday <name|Dmitri Volkov> handed the keys to <name|Fatima Al-Sayed> at reception.
Could you forward this to <name|Sarah Thornbury>? She handles refunds.
The parcel was signed for by <name|Tomoko Ishikawa> on Friday.
Regards, <name|Bogdan Ionescu>
Our landlord, <name|Gunther Pohl>, raised the rent again.
Hello <name|Amelia Stone>, thank you for your letter.
I spoke with <name|Rashid Karimov> and <name|Lucinda Bell> last week.
Patient: <name|Edith Lundgren>, room 14.
Bitte melden Sie sich bei <name|Annegret Vogel> im Sekretariat.
Le colis est pour <name|Baptiste Rousseau>, merci.
Pregunta por <name|Marisol Quintero> en la entrada.
<name|Oleksandr Shevchenko> joined the team in May.
My cousin <name|Desmond Tutuola> lives in Lagos.
The form was filled in by <name|Mei-Ling Tan>.
<name|Kieran O'Shea> replied within an hour.
Dr. <name|Vivek Menon> will see you now.
Author: <name|Camilla Bergstrom>
Mrs. <name|Patricia Holloway> left a message.
Is there a <name|Stefano Lombardi> staying here?
The winner is <name|Grace Nakamura>!
Write to <email|helen.marsh@northgate.org> for details.
Her address is <email|r.popescu88@mailbox.ro>, I think.
Reply to <email|office+billing@kleinundpartner.de> by noon.
<email|zofia_k@poczta.pl> bounced.
Send the scan to <email|j.doe [at] webmail.net> please.
Questions? <email|help.desk@city.gov.uk>
Mein Postfach: <email|lena-marie@web.de>
Call me back on <phone|+44 20 7946 0958>.
My new number is <phone|(415) 555-0136>.
Reach the clinic at <phone|0151 496 0321>.
Handy: <phone|0176 12345678>
Appelez-moi au <phone|06 39 98 12 34>.
Mi móvil es <phone|+34 612 34 56 78>.
Phone <phone|+48 512 345 678> after lunch.
Text <phone|555-867-5309> when you arrive.
Ring <phone|+91 98450 12345> at night.
Her NHS number is <id_number|943 476 5919>.
SSN: <id_number|078-05-1120>
Passport no. <id_number|X4R821937> expired.
My social security number <id_number|219-09-9999> was stolen.
Personalausweis <id_number|L01X00T471>
DNI <id_number|12345678Z>, issued in Bilbao.
National Insurance number <id_number|AB 12 34 56 C>
codice fiscale <id_number|RSSMRA85T10A562S>
Steuer-ID <id_number|86095742719>
Ship it to <address|17 Acacia Avenue>, Reading.
She moved to <address|42 Wallaby Way>, Sydney.
Ich wohne in der <address|Leopoldstraße 84>, München.
Wir treffen uns in der <address|Alten Gasse 7>.
J'habite <address|15 rue Mouffetard>, Paris.
Vivo en la <address|Calle Serrano 21>, Madrid.
L'ufficio è in <address|Via Nazionale 91>, Roma.
Deliver to <address|221B Baker Street>, London.
Het kantoor is op <address|Keizersgracht 126>, Amsterdam.
Please post it to <address|PO Box 7714>, Dublin.
Mail the keys to <address|9 Elmwood Drive>, Austin.
"""

#: Nothing in these is personal.
OTHERS = """
The Grand Hotel opens on Monday.
Talk to Overlord Skarn Nightreaver near the Bone Pit.
Burning Crusade was a long time ago.
Guild Wars and Dark Souls are on sale.
Order 4471-90211 shipped on 12/05/2023.
Lady Vashira Moonspear drops the Shattered Prism.
Level 60 is reached after 240 hours.
The North Sea is cold in January.
Build 10.2.7.54988 broke the Emerald Gate.
Ticket #88213471 is still open.
Zandrok the Cruel patrols at 44.1, 72.9.
United Nations and Red Cross sent help.
Thursday Morning News, page 3
Bring 15 Spotted Feathers to Elder Mokra.
It took 12 people on the square.
""".strip().splitlines()


def sentences():
    """(text, [(kind, start)]) of each."""
    import re

    for line in SENTENCES.strip().splitlines():
        text, spans, at = "", [], 0
        for m in re.finditer(r"<(\w+)\|([^>]*)>", line):
            text += line[at : m.start()]
            spans.append((m[1], len(text)))
            text += m[2]
            at = m.end()
        yield text + line[at:], spans
