"""Written-out forms of makes that the tagger hasn't learned from, for measuring."""

import random

from dyelake.llm.pii import _luhn


def unknown_make(rng: random.Random) -> tuple[str, str | None]:
    """A form, with its kind, or one that only looks like personal data (None)."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    chars = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    word = lambda: chars(rng.randint(3, 8), "abcdefghilmnoprstuwyk")
    byte, area = lambda: str(rng.randint(0, 255)), lambda: f"{rng.randint(2, 9)}{digits(2)}"
    hexed, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def card(mark: str) -> str:
        while not _luhn(n := f"{rng.randint(3, 6)}{digits(15)}"):
            pass
        return mark.join(n[i : i + 4] for i in range(0, 16, 4))

    quote = rng.choice(('"', "'", ""))
    name, host, end = rng.choice((f"{word()}-{word()}", f"{word()}.{word()}.{word()}", f"{digits(1)}{word()}")), f"{word()}{digits(1)}", rng.choice(("io", "info", "fr"))
    spelled = rng.choice((f"{name} @ {host}.{end}", f"{name} [ at ] {host} [ dot ] {end}", f"{name} <at> {host} . {end}.{end}"))
    phone = rng.choice((f"({area()})-{digits(3)}-{digits(4)}", f"[{area()}] {digits(3)}-{digits(4)}"))
    key = rng.choice((f"auth_token := {quote}{chars(32, hexed)}{quote}", f"client_secret={quote}{chars(28, mixed)}{quote}", chars(36, hexed), f"ghs_{chars(36, mixed)}", f"xoxb-{chars(24, mixed)}"))
    address = rng.choice((*(m.join(byte() for _ in range(4)) for m in ("{.}", " (.) ", "{dot}")), ":".join(chars(4, hexed) for _ in range(7)) + "::"))
    number, ssn = card(rng.choice((":", "|"))), rng.choice((":", "--")).join((f"{rng.randint(1, 8)}{digits(2)}", digits(2), digits(4)))
    odd = rng.choice((f"{digits(2)}/{digits(2)}/19{digits(2)}", f"no. {digits(5)}", f"{digits(2)},{digits(3)} km", f"Fig. {digits(1)}.{digits(2)}", f"{digits(3)}%", f"Q{rng.randint(1, 4)} 20{digits(2)}", f"{word()}/{word()}/{word()}", f"pp. {digits(2)}-{digits(2)}", f"{word()}{word()}-{word()}"))
    return rng.choice(((spelled, "email"), (spelled, "email"), (phone, "phone"), (phone, "phone"), (key, "secret"), (address, "ip"), (number, "card"), (ssn, "ssn"), (odd, None), (odd, None), (odd, None)))
