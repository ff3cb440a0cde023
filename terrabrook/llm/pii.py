"""PII: high-recall generators propose spans, boosted trees score them, calibrated thresholds select.

The base kinds (email, ip, card, phone) have fixed grammars and always stay.  Further generators
propose national phone numbers, identity numbers, IBANs, written-out e-mail addresses, IPv6
addresses, street addresses and secrets (keys, tokens, passwords), overlapping as they may.  A small
gradient-boosted ensemble scores each candidate from its format, its own check (mod 97, check letters,
number areas, known key forms) and the words before it; scoring is DataFrame functions only.  The trees
are fitted here on generated examples (fixed seed, TRAIN_ROWS of them) because the tables hold no
labelled spans; half of the examples set, per kind, the least threshold at which precision is at least
PRECISION.  No generator bounds a value's length but by its format, and all are linear in the text.
"""

from __future__ import annotations

import functools
import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .spans import matches

# The grammars of the base kinds. Possessive quantifiers and looks behind leave the matches as they
# are and keep Java's matcher from backtracking over, or starting at each place of, long runs.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")

#: Kinds the method adds, in the order of the spans column, with generator patterns.
ADDED = {
    "local_phone": r"(?<![0-9+/-])(?<![0-9][.,])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ ./-]{1,2}[0-9]{2,8}(?:[ ./-][0-9]{2,8}){0,3}(?![0-9]|[.,/-][0-9])"
    r"|(?<![A-Za-z0-9_+.,/$#-])[0-9]{9,11}(?![A-Za-z0-9_]|[.,/-][0-9])",
    "id_number": r"(?<![A-Za-z0-9.-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{1,2}[0-9]{6,8}[A-Z]?|[0-9]{8}[ -]?[A-Z])(?![A-Za-z0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "written_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(<{] ?(?:at|AT|@) ?[\])>}] ?[A-Za-z0-9-]++(?: ?(?:[\[(<{] ?(?:dot|DOT) ?[\])>}]|\.) ?[A-Za-z0-9-]++)++"
    r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: (?:dot|DOT) [A-Za-z0-9._%+-]++)*+ (?:at|AT) [A-Za-z0-9-]++(?: (?:dot|DOT) [A-Za-z0-9-]++)*? (?:dot|DOT) (?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|co)(?![A-Za-z0-9-])",
    "ipv6": r"(?<![A-Za-z0-9:])(?=[0-9A-Fa-f]*+:[0-9A-Fa-f]*+:)(?:[0-9A-Fa-f]{1,4}:){1,7}:?[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}(?![A-Za-z0-9:])",
    "address": r"(?<![0-9A-Za-z])[0-9]{1,5} [A-Z][a-z]{2,20}(?: [A-Z][a-z]{2,20})? (?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Court|Ct)(?![A-Za-z])"
    r"|(?<![0-9A-Za-zÄÖÜäöüß])[A-ZÄÖÜ][a-zäöüß]{2,30}(?:straße|strasse|weg|platz|gasse|allee) [0-9]{1,4}[a-z]?(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])[0-9]{1,4}(?: bis| ter)?,? (?:rue|avenue|boulevard|chemin|impasse)(?: (?:de|du|des|la|le|les)){0,2} (?:[dl]')?[A-ZÀ-Ý][a-zà-ÿ]{2,20}(?:[ -][A-ZÀ-Ý][a-zà-ÿ]{2,20})?(?![A-Za-z])"
    r"|(?<![0-9A-Za-z])(?:Calle|calle|Avenida|avenida|Paseo|paseo|Plaza|plaza)(?: (?:de|del|la|las|los)){0,2} [A-ZÀ-Ý][a-zà-ÿ]{2,20}(?: [A-ZÀ-Ý][a-zà-ÿ]{2,20})?,? [0-9]{1,4}(?![0-9A-Za-z])",
    "secret": r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]++-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----"
    r"|(?<![A-Za-z0-9_.-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+(?:\.[A-Za-z0-9_-]{10,}+)?"
    r"|(?<=(?:[Pp]ass[Ww]ord|PASSWORD|[Pp]asswd|PASSWD|[Pp]asswort|[Pp]wd|PWD)[\"']{0,1} {0,2}[:=] {0,2}[\"']{0,1})[^\s\"':=]{6,}(?![^\s\"',;)])"
    r"|(?<=(?:[Pp]assword|[Pp]assphrase|[Pp]asscode|[Pp]asswort|[Cc]ontraseña|[Mm]ot de passe) {0,1}(?:is|was|ist|lautet|es|est|:) [\"']{0,1})(?=[^\s\"':=]*?[0-9!@#$%^&*])[^\s\"':=]{6,}(?<![.,;?)])"
    r"|(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+={0,2}(?![A-Za-z0-9_+/=-])",
}
#: A text without this has no candidate of the kind (a cheap test before the pattern).
NEEDS = {
    "local_phone": "[0-9]{2}[) ./-]{1,3}[0-9]{2}|[0-9]{9}", "id_number": "[0-9]{6}|[0-9]{2}-[0-9]{4}", "iban": "[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", "written_email": r"[\[(<{] ?(?:at|AT|@) ?[\])>}]| (?:dot|DOT) ", "ipv6": "[0-9A-Fa-f]:[0-9A-Fa-f:]", "address": "[0-9] [A-Z]|[a-zß] [0-9]|[0-9r],? [rabci]",
    "secret": "[0-9][A-Za-z_+/-]|[A-Za-z_+/-][0-9]",
}
#: Kinds of which every candidate has a digit, or one of the words.
DIGITS = ("local_phone", "id_number", "iban", "address", "secret")
WORDS = {"secret": ("PRIVATE KEY", "assw", "assW", "ASSW", "pwd", "Pwd", "PWD", "assphrase", "asscode", "ontraseña", "ot de passe")}
CONTEXT = 40
GOOD_WORDS = {
    "local_phone": r"(?i)\b(?:phone|tel|call|fax|mobile|cell|whatsapp|telefon|telefono|teléfono|téléphone|numéro|handy|rufnummer|portable|móvil|ring|text|dial|reach|sms)[a-z.]*\W*(?:\w+\W+){0,2}$",
    "id_number": r"(?i)\b(?:ssn|social security|passport|national id|id card|dni|nie|ausweis|personal|reisepass|carte d'identité|passeport|pasaporte|licen[cs]e)(?: (?:no|number|nummer|num|id))?\.?\W*(?:\w+\W+)?$",
    "iban": r"(?i)\b(?:iban|account|konto|cuenta|compte|bank)\W*(?:\w+\W+)?$",
    "written_email": r"(?i)\b(?:mail|contact|write|reach|kontakt|correo|courriel)\W*(?:\w+\W+){0,2}$",
    "ipv6": r"(?i)\b(?:ip|ipv6|address|host|from|client|adresse)\W*(?:\w+\W+)?$",
    "address": r"(?i)\b(?:address|lives?|at|home|ship|deliver|resid\w+|send|wohn\w+|adresse|anschrift|domicilio|direcci[oó]n|vive|habite|domicile)\W*(?:\w+\W+){0,2}$",
    "secret": r"(?i)(?:api|access|secret|private|auth|signing|encryption|client|session|bearer|token|passw(?:or)?[dt]|passwd|pwd|credential|key|passphrase|passcode|passwort|contraseña|mot de passe)[a-z0-9_.-]*[\"']?\s*(?:[:=]|=>|:=| (?:is|was|ist|lautet|es|est) )?\s*[\"'`]?(?:bearer |basic )?$",
}
BAD_WORDS = r"(?i)\b(?:order|invoice|version|isbn|issn|doi|part|item|sku|ref|reference|model|build|serial|score|page|pages|chapter|time|date|year|total|no|nr|ticket|bestell|factura|commande|ratio|verse|line|commit|sha[0-9-]*|md5|checksum|digest|hash|revision|rev|etag|blob|tree|parent|integrity|uuid|guid|image|file|layer|room|zimmer|salle|seat|row|gate|lot|section|fig|figure|table|numbers|population|id)[a-z.]*\W*(?:(?:no|number|nummer)\.?\W*)?$"
#: A value after a sign of assignment; a value that stands in a row of a table or list.
ASSIGNED, LISTED = r"[:=]\s*[\"'`]?$", r"(?:^|[\n\t,;|])\s*[\"']?$"
KNOWN_SECRETS = r"^(?:AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|sk-|sk_live_|rk_live_|xox[abpsr]-|AIza|eyJ|-----BEGIN|npm_|pypi-|SG\.|hf_|ya29)"
DNI = "TRWAGMYFPDXBNJZSQVHLCKE"
#: A number before one of these, or a year before Court, counts something or dates it; it is no house number.
NO_STREET = r"^[0-9]+ (?:Supreme|High|Federal|District|Superior|Appeals?|Circuit|Crown|Hour|Mile|Hard|Flash|Disk|Test|Wall|Tennis|Royal) |^(?:1[89]|20)[0-9]{2} .*Court$"
FEATURES = ("length", "digits", "groups", "separators", "paren", "letters", "capitals", "distinct", "hex", "good", "bad", "assigned", "listed", "valid", "zero")
TRAIN_ROWS = 7000
TREES, DEPTH, RATE = 16, 4, 0.4
PRECISION = 0.98


def valid(kind: str, found: str) -> bool:
    """The kind's own check of a candidate; valid_sql is the same as SQL."""
    plain = re.sub(r"[^A-Za-z0-9]", "", found)
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "iban":
        rest = 0
        for c in plain[4:] + plain[:4]:
            rest = (rest * 10 + int(c)) % 97 if c.isdigit() else (rest * 100 + ord(c) - 55) % 97
        return rest == 1
    if kind == "id_number":
        if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", found):
            return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
        return bool(re.fullmatch(r"[0-9]{8}[A-Z]", plain)) and DNI[int(digits) % 23] == plain[-1]
    if kind == "ipv6":
        return ("::" in found) != (found.count(":") == 7) and bool(re.search(r"[A-Fa-f]|[0-9]{3}", found))
    if kind == "local_phone":
        return 7 <= len(digits) <= 12 and not re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4}[./-][0-9]{2}[./-][0-9]{2}|[0-9]{2}[./-][0-9]{2}[./-][0-9]{4}|[0-9]{4} ?[/-] ?[0-9]{4}", found)
    if kind == "written_email":
        return bool(re.search(r"(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|co)$", found))
    if kind == "address":
        return not re.search(NO_STREET, found)
    return bool(re.search(KNOWN_SECRETS, found)) if kind == "secret" else True


def valid_sql(kind: str) -> str:
    """valid of a candidate m.found, as SQL."""
    plain, digits = "regexp_replace(m.found, '[^A-Za-z0-9]', '')", "regexp_replace(m.found, '[^0-9]', '')"
    if kind == "iban":
        step = "if(c between '0' and '9', (r * 10 + ascii(c) - 48) % 97, (r * 100 + ascii(c) - 55) % 97)"
        return f"aggregate(filter(split(concat(substring({plain}, 5), left({plain}, 4)), ''), c -> c <> ''), 0, (r, c) -> {step}) = 1"
    if kind == "id_number":
        social = f"left({digits}, 3) not in ('000', '666') and left({digits}, 1) <> '9' and substring({digits}, 4, 2) <> '00' and substring({digits}, 6) <> '0000'"
        letter = f"{plain} rlike '^[0-9]{{8}}[A-Z]$' and substring('{DNI}', cast(cast({digits} as bigint) % 23 as int) + 1, 1) = right({plain}, 1)"
        return f"if(m.found rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$', {social}, {letter})"
    if kind == "ipv6":
        return "(contains(m.found, '::') <> (regexp_count(m.found, ':') = 7)) and m.found rlike '[A-Fa-f]|[0-9]{3}'"
    if kind == "local_phone":
        return f"length({digits}) between 7 and 12 and not (m.found rlike '^(?:[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}|[0-9]{{4}}[./-][0-9]{{2}}[./-][0-9]{{2}}|[0-9]{{2}}[./-][0-9]{{2}}[./-][0-9]{{4}}|[0-9]{{4}} ?[/-] ?[0-9]{{4}})$')"
    if kind == "written_email":
        return "m.found rlike '(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|co)$'"
    if kind == "address":
        return f"not m.found rlike {literal(NO_STREET)}"
    return f"m.found rlike {literal(KNOWN_SECRETS)}" if kind == "secret" else "true"


def literal(text: str) -> str:
    """A string as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def features(kind: str, found: str, before: str) -> list[float]:
    """The features of a candidate; features_sql gives the same."""
    digits = re.sub(r"[^0-9]", "", found)
    has = lambda pattern, text: bool(re.search(pattern, text, re.A))
    return [
        float(x) for x in (
            len(found), len(digits), len(re.findall(r"[0-9]+", found)), len(set(re.sub(r"[A-Za-z0-9]", "", found))), "(" in found, len(re.sub(r"[^A-Za-z]", "", found)), len(re.sub(r"[^A-Z]", "", found)), len(set(found)),
            has(r"^[0-9a-f-]*$|^[0-9A-F-]*$", found), has(GOOD_WORDS[kind], before), has(BAD_WORDS, before), has(ASSIGNED, before), has(LISTED, before), valid(kind, found), found.lstrip("(").startswith("0"),
        )
    ]


def features_sql(kind: str) -> list[str]:
    """The features of a candidate m (found, before), in the order of FEATURES."""
    has = lambda pattern, text: f"cast({text} rlike {literal(pattern)} as int)"
    distinct = lambda text: f"size(array_distinct(filter(split({text}, ''), c -> c <> '')))"
    return [
        "length(m.found)", "length(regexp_replace(m.found, '[^0-9]', ''))", "regexp_count(m.found, '[0-9]+')", distinct("regexp_replace(m.found, '[A-Za-z0-9]', '')"), "cast(contains(m.found, '(') as int)",
        "length(regexp_replace(m.found, '[^A-Za-z]', ''))", "length(regexp_replace(m.found, '[^A-Z]', ''))", distinct("m.found"), has("^[0-9a-f-]*$|^[0-9A-F-]*$", "m.found"),
        has(GOOD_WORDS[kind], "m.before"), has(BAD_WORDS, "m.before"), has(ASSIGNED, "m.before"), has(LISTED, "m.before"), f"cast({valid_sql(kind)} as int)", has(r"^\(*0", "m.found"),
    ]


def examples(kind: str, n: int) -> list[tuple[str, str, int]]:
    """Generated candidates: found, the text before it, and whether it is personal data.

    Neither format nor context decides alone: half of the positives stand in plain prose or in lists
    without a word that names them, a fifth of the negatives behind a word that does, and values of
    formats that say little by themselves (weak) are positives behind such a word only.
    """
    rng = random.Random(f"{kind} 7")
    pick = rng.choice
    d = lambda k: "".join(pick("0123456789") for _ in range(k))
    of = lambda k, chars: "".join(pick(chars) for _ in range(k))
    word = lambda: "".join(pick("aeioulnrst") for _ in range(rng.randint(2, 8)))
    name = lambda: "".join(pick("aeioulnrst") for _ in range(rng.randint(4, 9))).title()
    house = lambda: str(rng.randint(1, 10 ** rng.randint(1, 4)))
    tld = lambda: pick(("com", "org", "de", "net", "fr", "es"))
    mixed, hexes = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef"

    def with_digit(make):
        while not (re.search("[0-9]", x := make()) and re.search("[A-Za-z]", x)):
            pass
        return x

    def iban(good: bool):
        while True:
            country, n = pick((("DE", 18), ("ES", 20), ("FR", 23), ("GB", 18), ("NL", 14)))
            account = of(4, "ABCDGHKLN") + d(n - 4) if country in ("GB", "NL") else d(n)
            check = next(c for c in range(2, 99) if valid("iban", f"{country}{c:02}{account}"))
            plain = f"{country}{check if good else rng.randint(2, 98):02}{account}"
            if valid("iban", plain) == good:
                return plain if rng.random() < 0.4 else " ".join(plain[i : i + 4] for i in range(0, len(plain), 4))

    def social(good: bool):
        while valid("id_number", x := f"{d(3)}-{d(2)}-{d(4)}") != good:
            pass
        return x

    def dni(good: bool):
        n = d(8)
        right = DNI[int(n) % 23]
        return n + pick(("", "-", " ")) + (right if good else pick(DNI.replace(right, "")))

    leads = {
        "local_phone": ["phone ", "tel. ", "call me on ", "mobile: ", "fax ", "telefon: ", "teléfono ", "téléphone : ", "call "], "id_number": ["SSN ", "passport no ", "DNI ", "social security number ", "passport: ", "Ausweis "],
        "iban": ["IBAN ", "account ", "Konto: ", "bank "], "written_email": ["mail ", "contact me: ", "e-mail: ", "reach me "], "ipv6": ["from ", "client ip ", "host ", "address "], "address": ["lives at ", "address: ", "home ", "ship to "],
        "secret": ['token = "', "api_key: ", "secret=", "AWS_SECRET_ACCESS_KEY=", "Authorization: Bearer ", "password: ", 'client_secret": "', "export API_TOKEN=", "the access token is ", "auth_token => '", 'passwd = "', "private key: "],
    }[kind]
    misleading = ["order ", "invoice no ", "version ", "ISBN ", "item ", "pages ", "ref ", "score ", "ticket ", "part number ", "build ", "commit ", "sha256: ", "md5 ", "checksum: ", "digest=", "revision ", "uuid ", "file ", 'etag: "']
    listed = ["\n", ", ", "; ", "\t", "| ", '\n"']
    own = {
        "local_phone": lambda: pick([f"0{d(2)} {d(3)} {d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"0{d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}", f"{d(3)} {d(3)} {d(4)}", f"(0{d(2)}) {d(3)}-{d(4)}", f"0{d(2)} {d(7)}", f"0{d(3)} {d(6)}", f"01{d(2)} {d(8)}", f"0{d(3)}/{d(6)}", f"0{d(9)}", f"0{d(1)}.{d(2)}.{d(2)}.{d(2)}.{d(2)}"]),
        "id_number": lambda: pick([social(True), dni(True)]),
        "iban": lambda: iban(True),
        "written_email": lambda: pick([
            f"{word()}{pick(('.', '', '_'))}{word()} {pick(('[at]', '(at)', '(@)', '{at}'))} {word()}{pick((' [dot] ', ' (dot) ', '.'))}{tld()}", f"{word()} at {word()} dot {tld()}", f"{word()} dot {word()} at {word()} dot {tld()}",
        ]),
        "ipv6": lambda: pick([":".join(pick(("2001", "fe80", of(4, hexes), of(3, hexes), "db8")) for _ in range(8)), f"2001:db8::{of(4, hexes)}:{of(4, hexes)}", f"fe80::{of(3, hexes)}:{of(4, hexes)}:{of(4, hexes)}", f"2001:{of(3, hexes)}::{of(4, hexes)}:{of(2, hexes)}:{of(4, hexes)}", f"{pick(('fe80', '2001:db8', 'fd' + d(2), '2a0' + d(1) + ':' + d(4)))}::{of(rng.randint(0, 3), hexes)}{d(1)}"]),
        "address": lambda: pick([
            f"{house()} {name()} {pick(['Street', 'Avenue', 'Road', 'Lane', 'Drive', 'St', 'Ave', 'Rd', 'Court', 'Boulevard'])}", f"{name()}{pick(['straße', 'weg', 'platz', 'allee'])} {house()}",
            f"{house()} {pick(['rue', 'avenue', 'chemin'])} {pick(['de ', 'du ', ''])}{name()}", f"{pick(['Calle', 'Avenida', 'Paseo'])} {pick(['de ', ''])}{name()} {house()}",
        ]),
        "secret": lambda: with_digit(lambda: pick([of(40, hexes), of(40, hexes), of(32, hexes), of(64, hexes), of(rng.randint(20, 60), mixed), of(40, mixed + "+/"), of(43, mixed) + "=", of(rng.randint(16, 24), mixed)])),
    }[kind]
    known = lambda: pick(["AKIA" + of(16, mixed[:26] + "234567"), "ghp_" + of(36, mixed), "sk-" + of(48, mixed), f"xoxb-{d(12)}-{d(12)}-{of(24, mixed)}", f"eyJ{of(20, mixed)}.eyJ{of(40, mixed)}.{of(43, mixed)}", "AIza" + of(35, mixed)])
    other = {
        "local_phone": lambda: pick([f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(2)}.{d(2)}", f"{d(3)} {d(3)}", f"{d(4)} {d(4)} {d(4)}", f"{d(4)}-{d(4)}", f"{d(2)}-{d(2)}", f"{d(3)}.{d(2)}", f"{d(5)}/{d(2)}", f"{d(3)}-{d(2)}-{d(4)}", f"0{d(2)}-{d(2)}-{d(4)}", f"{d(2)} {d(2)}", f"{d(2)} {d(2)} {d(2)}"]),
        "id_number": lambda: pick([social(False), dni(False)]),
        "iban": lambda: iban(False),
        "written_email": lambda: f"{word()} (at) {word()}.{word()}xy",
        "ipv6": lambda: pick([f"{pick(('face', 'dead', 'Add', 'abe'))}::{pick(('bad', 'beef', 'cafe', 'Fed'))}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(1)}:{d(2)}:{d(2)}:{d(2)}", ":".join(of(2, hexes) for _ in range(6))]),
        "address": lambda: pick([f"{house()} {pick(['Supreme', 'High', 'Federal', 'District', 'Crown'])} Court", f"{house()} {pick(['Hour', 'Test', 'Hard', 'Flash'])} Drive", f"{pick((18, 19, 20))}{d(2)} {name()} Court", f"{house()} Mile Road"]),
        "secret": lambda: with_digit(lambda: pick([f"{of(8, hexes)}-{of(4, hexes)}-{of(4, hexes)}-{of(4, hexes)}-{of(12, hexes)}", f"{word()}_{word()}_{d(4)}_{word()}{word()}", f"{word()}-{d(4)}-{word()}-{word()}-{word()}", f"/{word()}/{word()}/{d(4)}/{d(2)}/{word()}", f"{word()}{word()}{word()}{d(3)}"])),
    }[kind]
    run = lambda: " ".join(str(rng.randint(1, 9)) + d(1) for _ in range(rng.randint(4, 5)))
    weak = {
        "local_phone": lambda: pick([f"{rng.randint(1, 9)}{d(2)} {d(7)}", str(rng.randint(10**8, 10**10)), run(), run(), f"{rng.randint(1, 9)}{d(2)}{pick(' -')}{d(4)}", f"{d(3)} {d(3)} {d(3)}"]),
        "id_number": lambda: pick([f"{of(1, 'ABCFGHJKXYZ')}{d(rng.randint(6, 8))}", f"{of(2, 'ABCXYZ')}{d(rng.randint(6, 7))}"]),
        "secret": lambda: with_digit(lambda: of(rng.randint(8, 14), mixed + "!#$")),
    }.get(kind)
    found = []
    for _ in range(n):
        prose, u = f"{word()} {word()}{pick((' ', ' ', '. ', ', '))}", rng.random()
        if weak and rng.random() < 0.3:
            if kind == "secret":
                found.append((weak(), prose + pick(["my password is ", "password: ", "the passphrase is ", 'pwd="', "Passwort ist "]), 1))
            else:
                found.append((weak(), prose + pick(leads), 1) if rng.random() < 0.5 else (weak(), prose + pick([*misleading, "", "", *listed]), 0))
        elif rng.random() < 0.5:
            if kind == "secret":  # without a known form, only the context makes a random string a secret
                known_form = rng.random() < 0.3
                found.append((known(), prose + pick([*leads, "", *listed]), 1) if known_form else (own(), prose + pick(leads), 1))
            else:
                found.append((own(), prose + (pick(leads) if u < 0.5 else "" if u < 0.8 else pick(listed)), 1))
        elif kind == "secret" and u < 0.5:
            found.append((own(), prose + (pick(misleading) if rng.random() < 0.8 else pick(listed)), 0))
        else:
            found.append((other(), prose + (pick(leads) if u < 0.2 else pick(misleading) if u < 0.6 else "" if u < 0.85 else pick(listed)), 0))
    return found


def grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int):
    """A regression tree on the loss's gradient and curvature: a leaf's value, or (feature, cut, low, high)."""
    leaf = float(gradient.sum() / (weight.sum() + 1.0))
    if not depth or len(gradient) < 20:
        return leaf
    base, best = gradient.sum() ** 2 / (weight.sum() + 1.0), (1e-3, None, None)
    for f in range(x.shape[1]):
        for at in np.unique(x[:, f])[:-1]:
            low = x[:, f] <= at
            gain = gradient[low].sum() ** 2 / (weight[low].sum() + 1.0) + gradient[~low].sum() ** 2 / (weight[~low].sum() + 1.0) - base
            if gain > best[0]:
                best = (gain, f, float(at))
    if best[1] is None:
        return leaf
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[low], gradient[low], weight[low], depth - 1), grow(x[~low], gradient[~low], weight[~low], depth - 1)


def evaluate(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@functools.cache
def model(kind: str) -> tuple[tuple, float]:
    """The trees for a kind and the score from which a candidate is selected."""
    rows = examples(kind, TRAIN_ROWS // len(ADDED))
    x = np.array([features(kind, f, b[-CONTEXT:]) for f, b, _ in rows])
    y = np.array([label for *_, label in rows], float)
    half = len(y) // 2
    trees, score = [], np.zeros(half)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        tree = grow(x[:half], y[:half] - p, p * (1 - p), DEPTH)
        trees.append(tree)
        score += RATE * np.array([evaluate(tree, r) for r in x[:half]])
    held = np.array([RATE * sum(evaluate(t, r) for t in trees) for r in x[half:]])
    order = np.argsort(-held, kind="stable")
    precision = np.cumsum(y[half:][order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero((precision >= PRECISION) & np.append(np.diff(held[order]) < 0, True))
    if not len(good):
        return tuple(trees), float("inf")
    ranked = np.append(held[order], -np.inf)
    return tuple(trees), float(ranked[good[-1]] - min(0.1, (ranked[good[-1]] - ranked[good[-1] + 1]) / 2))


@functools.cache
def score_sql(kind: str) -> str:
    """The trees' sum for a candidate m with its features as m.f, as one SQL expression."""

    def branch(tree) -> str:
        return f"if(m.f.{FEATURES[tree[0]]} <= {tree[1]}, {branch(tree[2])}, {branch(tree[3])})" if isinstance(tree, tuple) else f"{tree!r}D"

    return f"{RATE}D * ({' + '.join(branch(t) for t in model(kind)[0])})"


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        x = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_matches(text: Column, kind: str) -> Column:
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}[kind]
    need = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, F.rlike(text, F.lit("[0-9]")))
    digits = lambda m: F.regexp_replace(m["found"], "[^0-9]", "")
    keep = {
        "email": lambda m: F.lit(True),
        # any run of zeros, then at most 255
        "ip": lambda m: F.forall(F.split(m["found"], r"\."), lambda x: F.rlike(x, F.lit(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))),
        "card": lambda m: F.length(digits(m)).between(16, 19) & luhn(digits(m)),
        "phone": lambda m: F.length(digits(m)).between(8, 15),
    }[kind]
    return F.when(need, F.filter(matches(text, F.lit(pattern)), keep)).otherwise(F.array().cast("array<struct<start:int,end:int,found:string>>"))


CANDIDATE = "struct<start:int,end:int,found:string,kind:string,score:double>"


def candidates(kind: str, matched: str, text: str) -> str:
    """SQL: of the matches in a column those that the kind's trees select, as an array of CANDIDATE.

    Features are computed once for a candidate, and the score (a probability) from them.
    """
    seen = f"transform({matched}, m -> named_struct('start', m.start, 'end', m.end, 'found', m.found, 'before', substring({text}, greatest(m.start - {CONTEXT} + 1, 1), least(m.start, {CONTEXT}))))"
    columns = ", ".join(f"'{name}', {sql}" for name, sql in zip(FEATURES, features_sql(kind), strict=True))
    featured = f"transform({seen}, m -> named_struct('start', m.start, 'end', m.end, 'found', m.found, 'f', named_struct({columns})))"
    scored = f"transform({featured}, m -> named_struct('start', m.start, 'end', m.end, 'found', m.found, 'kind', '{kind}', 'raw', {score_sql(kind)}))"
    chosen = f"filter({scored}, m -> m.raw >= {model(kind)[1]!r}D)"
    return f"transform({chosen}, m -> named_struct('start', m.start, 'end', m.end, 'found', m.found, 'kind', m.kind, 'score', 1 / (1 + exp(-m.raw))))"


def best_apart(every: Column) -> Column:
    """Of candidates that overlap, from left to right, the one with the better score; of equal scores the first."""
    none = F.array().cast(f"array<{CANDIDATE}>")
    start = F.struct(F.lit(None).cast(CANDIDATE).alias("last"), none.alias("kept"))

    def step(a: Column, m: Column) -> Column:
        clear = a["last"].isNull() | (a["last"]["end"] <= m["start"])
        return F.when(clear, F.struct(m.alias("last"), F.when(a["last"].isNull(), a["kept"]).otherwise(F.concat(a["kept"], F.array(a["last"]))).alias("kept"))).when(
            m["score"] > a["last"]["score"], F.struct(m.alias("last"), a["kept"].alias("kept"))
        ).otherwise(a)

    return F.when(F.size(every) > 1, F.aggregate(F.array_sort(every), start, step, lambda a: F.concat(a["kept"], F.array(a["last"])))).otherwise(every)


def may_hold(kind: str) -> Column:
    """Whether the text can have a candidate of the kind; plain searches before patterns."""
    pattern = F.rlike("text", F.lit(NEEDS[kind]))
    return functools.reduce(lambda a, w: a | F.contains("text", F.lit(w)), WORDS.get(kind, ()), F.rlike("text", F.lit("[0-9]")) & pattern if kind in DIGITS else pattern)


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, text and one array of spans (start, end in code points, found) per kind, for every row;
    added kinds' spans have their score besides.

    Null texts are empty.  Added spans that overlap a base span are left out; of those that overlap
    each other the better score stays.  Base spans of different kinds may overlap.  Repeated rows are
    searched alike.  Extra columns are not returned.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    nothing = F.array().cast("array<struct<start:int,end:int,found:string>>")
    matched = texts.select(
        "*", *[base_matches(F.col("text"), k).alias(k) for k in BASE], *[F.when(may_hold(k), matches(F.col("text"), F.lit(x))).otherwise(nothing).alias(f"_{k}") for k, x in ADDED.items()]
    )
    every = F.concat(*[F.expr(candidates(k, f"_{k}", "text")).cast(f"array<{CANDIDATE}>") for k in ADDED])
    base = F.concat(*BASE)
    apart = F.filter(every, lambda m: ~F.exists(base, lambda x: (x["start"] < m["end"]) & (m["start"] < x["end"])))
    # without a candidate none of this is looked at
    some = F.size(F.concat(*[F.col(f"_{k}") for k in ADDED])) > 0
    found = matched.select("doc_id", "text", *BASE, F.when(some, best_apart(apart)).otherwise(F.array().cast(f"array<{CANDIDATE}>")).alias("_added"))
    of = lambda k: F.transform(F.filter("_added", lambda m: m["kind"] == k), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["found"].alias("found"), m["score"].alias("score")))
    return found.select("doc_id", "text", *BASE, *[of(k).alias(k) for k in ADDED])


def marked(kind: str):
    return lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("minus_end"), F.lit(kind).alias("kind"))


def shown(kind: str):
    return lambda m: F.concat_ws(":", F.lit(kind), m["start"], m["end"])


def redact(found: DataFrame) -> DataFrame:
    """doc_id and the text of find_pii's rows with each span replaced by its kind in angle brackets."""
    spans = F.array_sort(F.flatten(F.array(*[F.transform(F.col(k), marked(k)) for k in (*BASE, *ADDED)])))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    joined = F.aggregate(spans, start, lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
        (-s["minus_end"]).alias("at"),
        F.concat(a["parts"], F.array(F.substring("text", a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("parts"),
    )))
    return found.select("doc_id", joined.alias("j"), "text").select("doc_id", F.concat(F.array_join("j.parts", ""), F.substring("text", F.col("j.at") + 1, F.length("text"))).alias("text"))


def listed(kinds) -> Column:
    return F.array_join(F.flatten(F.array(*[F.transform(F.col(k), shown(k)) for k in kinds])), ",")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    count = lambda kinds: functools.reduce(lambda a, b: a + b, [F.size(k) for k in kinds]).cast("long")
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE], F.sha2(listed(BASE), 256).alias("base_sha256"), listed((*BASE, *ADDED)).alias("spans"),
        F.size("secret").cast("long").alias("n_secret"), count((*BASE, *ADDED)).alias("n_spans"),
    )
