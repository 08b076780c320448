"""Personal data: patterns propose spans, checksums confirm them, context scores them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame

from candela.llm import common

#: Kinds in report order; the first four have a base pattern.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")

#: Words near a span that speak for its kind, in English, German, French and Spanish; whole words only.
SPEAKS_FOR = {
    "email": ("mail", "email", "mails", "emails", "contact", "write to", "schreiben", "kontakt", "courriel", "correo", "contacto", "escriba a"),
    "ip": ("ip", "address", "host", "login", "server", "adresse", "hôte", "serveur", "dirección", "servidor"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment", "karte", "kreditkarte", "zahlung", "carte", "paiement", "tarjeta", "pago"),
    "phone": ("phone", "telephone", "tel", "call", "mobile", "fax", "telefon", "anruf", "handy", "téléphone", "appeler", "teléfono", "llamar", "móvil"),
    "iban": ("iban", "account", "bank", "transfer", "konto", "überweisung", "compte", "banque", "virement", "cuenta", "banco", "transferencia"),
    "ssn": ("ssn", "social security"),
}
#: Words near a span that speak against any personal number.
SPEAKS_AGAINST = ("version", "isbn", "serial", "order no", "part no", "invoice", "seriennummer", "rechnung", "facture", "série", "factura", "versión")


def any_of(words: Sequence[str]) -> re.Pattern[str]:
    """One of the words, not as a part of another."""
    return re.compile(r"(?<![^\W\d_])(?:" + "|".join(sorted(words, key=len, reverse=True)) + r")(?![^\W\d_])")


FOR_KIND, AGAINST_ANY = {k: any_of(w) for k, w in SPEAKS_FOR.items()}, any_of(SPEAKS_AGAINST)
START = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
FOR, AGAINST, ENOUGH = 0.2, 0.3, 0.5
WINDOW = 40

# A dot or an @ cannot be matched by the parts beside it, so possessive
# repeats match what greedy ones would, without going back.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_TAIL = re.compile(r"[A-Za-z0-9._%+-]")
# No match starts inside a run of digits: it would fail where its start failed.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Narrower forms, tried where the wide ones ran into a neighbouring number.
CARD_FORMS = re.compile(
    r"(?<![0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5}|[0-9]{13,19}+)(?![0-9])"
)
PHONE_FORMS = re.compile(r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
DIGITS = re.compile(r"[0-9]")
DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    """Luhn check of a string of digits."""
    at = [ord(x) - 48 for x in reversed(digits)]
    return (sum(at[0::2]) + sum(DOUBLED[x] for x in at[1::2])) % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 check of an account number: letters count from 10, the first four signs go last."""
    plain = iban.replace(" ", "")
    rest = 0
    for sign in plain[4:] + plain[:4]:
        value = int(sign, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return 15 <= len(plain) <= 34 and rest == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Base addresses. Goes from one @ to the next, so its time is linear."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL_TAIL.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _digits(text: str, start: int, end: int) -> str:
    return "".join(DIGITS.findall(text, start, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") < 256


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The base spans of each kind."""
    out = {"email": list(emails(text)) if "@" in text else [], "ip": [], "card": [], "phone": []}
    for m in IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(text, *m.span())) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(text, *m.span())) <= 15:
                out["phone"].append(m.span())
    return out


def score(text: str, kind: str, start: int, end: int) -> float:
    """Starting score of the kind, moved by the words around the span."""
    near = f"{text[max(0, start - WINDOW):start]} {text[end:end + WINDOW // 2]}".lower()
    s = START[kind] + FOR * bool(FOR_KIND[kind].search(near)) - AGAINST * bool(AGAINST_ANY.search(near))
    return round(min(1.0, max(0.0, s)), 2)


def find(text: str) -> list[tuple[str, int, int, float, bool]]:
    """All spans of a text: (kind, start, end, score, base), by kind as listed, then start.

    Base spans always stay. A proposal beyond them needs its checksum, a score
    of ``ENOUGH``, and no overlap with a span of its kind.
    """
    base = base_spans(text)
    more: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if DIGITS.search(text):
        more["card"] = [m.span() for m in CARD_FORMS.finditer(text) if luhn(_digits(text, *m.span()))]
        more["phone"] = [m.span() for m in PHONE_FORMS.finditer(text)] if "+" in text else []
        more["iban"] = [m.span() for m in IBAN.finditer(text) if mod97(m[0])]
        more["ssn"] = [m.span() for m in SSN.finditer(text)] if "-" in text else []
    out = []
    for kind in KINDS:
        have = base.get(kind, [])
        out += [(kind, a, b, score(text, kind, a, b), True) for a, b in have]
        i = 0
        for a, b in more[kind]:
            while i < len(have) and have[i][1] <= a:
                i += 1
            if (i == len(have) or have[i][0] >= b) and (s := score(text, kind, a, b)) >= ENOUGH:
                out.append((kind, a, b, s, False))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda x: (order[x[0]], x[1]))


def detect(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per document: the kept columns and ``spans``.

    ``spans`` is an array of (kind, start, end, score, base), in code points,
    end exclusive; an empty or null text has none. One pass, no shuffle.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        cols["spans"] = [
            [{"kind": k, "start": a, "end": b, "score": s, "base": x} for k, a, b, s, x in find(t)]
            for t in cols["__text"]
        ]
        return cols

    kind = "spans array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
    return common.map_batches(
        common.keep_and_text(docs, text, keep), run, ", ".join(x for x in (common.fields(docs, keep), kind) if x)
    )
