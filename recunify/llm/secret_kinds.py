"""Labelled findings to learn secrets from: known key formats and look-alikes, in varied contexts.

No table labels secrets beyond the fixed patterns, so the scan's network also
learns from texts made here.  Each maker gives a value of one public format
(label 1) or of something that only looks like one (label 0); ``examples`` sets
it into a sentence, an assignment, a log line, JSON, a URL or a file.  Both
labels appear in the same contexts, so the value itself must tell, except for
spoken passwords, which only their sentence gives away.
"""

from __future__ import annotations

import random
import string
from collections.abc import Callable

_ALNUM = string.ascii_letters + string.digits
_UPPER_HEX, _HEX = "0123456789ABCDEF", "0123456789abcdef"
_B64 = _ALNUM + "+/"
_URL64 = _ALNUM + "-_"
_WORDS = ("account access time house river light table paper winter summer garden number letter village morning evening window "
          "people system report market record travel simple little always before between example server client version").split()


def _run(r: random.Random, alphabet: str, n: int) -> str:
    return "".join(r.choice(alphabet) for _ in range(n))


def _password(r: random.Random) -> str:
    w = r.choice(_WORDS)
    return r.choice([w.capitalize() + _run(r, string.digits, r.randint(2, 4)), _run(r, _ALNUM, r.randint(8, 14)),
                     w[:4] + _run(r, string.digits, 2) + r.choice(_WORDS).capitalize() + _run(r, string.digits, 1)])


def _uuid(r: random.Random) -> str:
    return "-".join(_run(r, _HEX, n) for n in (8, 4, 4, 4, 12))


# ---- fixed values: the beginnings and lengths of public key formats
SECRETS: dict[str, Callable[[random.Random], str]] = {
    "github": lambda r: r.choice(["ghp_", "gho_", "ghs_", "ghu_"]) + _run(r, _ALNUM, 36),
    "gitlab": lambda r: "glpat-" + _run(r, _URL64, 20),
    "slack": lambda r: f"xox{r.choice('bpa')}-{_run(r, string.digits, 11)}-{_run(r, string.digits, 12)}-{_run(r, _ALNUM, 24)}",
    "stripe": lambda r: r.choice(["sk_live_", "rk_live_", "sk_test_"]) + _run(r, _ALNUM, r.choice([24, 32])),
    "google": lambda r: "AIza" + _run(r, _URL64, 35),
    "npm": lambda r: "npm_" + _run(r, _ALNUM, 36),
    "twilio": lambda r: "SK" + _run(r, _HEX, 32),
    "jwt": lambda r: "eyJ" + _run(r, _URL64, r.randint(30, 90)),
    "aws": lambda r: _run(r, _B64, 40),
    "bearer": lambda r: _run(r, r.choice([_ALNUM, _URL64]), r.randint(24, 64)),
    "upper_hex": lambda r: _run(r, _UPPER_HEX, r.choice([32, 40, 64])),
    "short_hex": lambda r: _run(r, _HEX, r.choice([16, 20, 22])),
    "private_key": lambda r: "MII" + _run(r, _B64, r.randint(61, 180)),
    "spoken": _password,
}
LOOK_ALIKES: dict[str, Callable[[random.Random], str]] = {
    "uuid": lambda r: _uuid(r) if r.random() < 0.7 else _uuid(r).upper(),
    "order": lambda r: r.choice(["ORD-", "INV-", "PO", "No", "#", "Ref-", ""]) + _run(r, string.digits, r.randint(6, 16)),
    "phone": lambda r: r.choice(["+49-", "0", "555-", ""]) + _run(r, string.digits, 3) + r.choice(["-", "/", ""]) + _run(r, string.digits, r.randint(4, 8)),
    "date": lambda r: f"{r.randint(1970, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}" + r.choice(["", "T" + _run(r, string.digits, 2)]),
    "path": lambda r: "/".join(r.choice(_WORDS) + r.choice(["", _run(r, string.digits, 1)]) for _ in range(r.randint(2, 5))),
    "slug": lambda r: "-".join(r.choice(_WORDS) for _ in range(r.randint(2, 5))) + r.choice(["", "-" + _run(r, string.digits, r.randint(1, 4))]),
    "snake": lambda r: "_".join(r.choice(_WORDS) for _ in range(r.randint(2, 4))) + r.choice(["", _run(r, string.digits, 2)]),
    "camel": lambda r: "".join(r.choice(_WORDS).capitalize() for _ in range(r.randint(2, 4))) + r.choice(["", _run(r, string.digits, 1)]),
    "name_number": lambda r: r.choice(_WORDS) + _run(r, string.digits, r.randint(1, 6)),
    "iban": lambda r: r.choice(["DE", "FR", "ES", "GB"]) + _run(r, string.digits, r.randint(18, 22)),
    "version": lambda r: f"v{r.randint(0, 30)}-{r.randint(0, 99)}-{_run(r, string.digits, r.randint(1, 6))}",
    "word": lambda r: r.choice(_WORDS),
    "long_word": lambda r: "".join(r.choice(_WORDS) for _ in range(r.randint(3, 5))),
    "signs": lambda r: r.choice("-=_+") * r.randint(6, 60),
    "digits": lambda r: _run(r, string.digits, r.randint(6, 24)),
    "card": lambda r: r.choice(["", "-"]).join(_run(r, string.digits, 4) for _ in range(4)),
    "repeated": lambda r: (lambda w: w * (r.randint(16, 40) // len(w) + 1))(_run(r, _ALNUM, r.randint(1, 3))),
    "hyphen_word": lambda r: f"{r.choice(_WORDS)}-{r.choice(_WORDS)}-{r.choice(_WORDS)}",
}
# ------------------------------------------------------------------------

_SPOKEN = ("the password is {}", "my password is {} now", "log in with password {}", "use {} as the password", "passcode was {} then",
           "Passwort ist {}", "le mot de passe est {}", "la contraseña es {}")
_PLACES = ("{}", "we saw {} there", "see {} for more", "id: {}", 'key="{}"', "value = {},", '"id": "{}"', "({})", "found {}.", "{} and so on",
           "Authorization: Bearer {}", "export VALUE={}", "https://host.example/a/{}", "https://host.example/?q={}&x=1", "- {}\n", "line {} end",
           "call {} today", "{}:", "commit {} was merged", "file {} saved")


def examples(size: int, seed: int = 11) -> list[tuple[str, int, int, int, str]]:
    """(text, start, end, label, kind): about ``size`` of each label, kinds in turn."""
    r, out = random.Random(seed), []
    for label, makers in ((1, SECRETS), (0, LOOK_ALIKES)):
        kinds = sorted(makers)
        for i in range(size):
            kind = kinds[i % len(kinds)]
            value = makers[kind](r)
            place = r.choice(_SPOKEN if kind == "spoken" else _PLACES)
            before, after = place.split("{}")
            before = f"{' '.join(r.choice(_WORDS) for _ in range(r.randint(0, 4)))} {before}"
            after = f"{after} {' '.join(r.choice(_WORDS) for _ in range(r.randint(0, 2)))}"
            out.append((before + value + after, len(before), len(before) + len(value), label, kind))
    return out
