from __future__ import annotations

import hashlib
import random
import re

import pytest

from orderlens.llm import secrets
from support import docs_table

A_SECRET = "Zx81kPq7Lm2"


def literals(text):
    return [text[s.start : s.end] for s in secrets.spans(text) if s.kind == "literal"]


def base_by_hand(text):
    """The base spans from the definition: letter by letter classes, short matches dropped afterwards."""

    def either(word):
        return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)

    names = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    assign = re.compile("(" + names + ")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    found = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


TEXTS = [
    None,
    "",
    "é" * 5 + ' PassWord = "abc123" token:x api_key : aaaaaa',
    "passwd=12345 secret='123456",
    "toKen = a=b=c=d AKIA" + "A" * 16 + " AKIA" + "B" * 15,
    "AKIA" + "0" * 30 + " secret=" + "f" * 30,
    "0123456789abcdef01234567 0123456789abcdef0123456",
    "paſſword=abcdefgh to\u212aen=abcdefgh",
    "token=token=secret=abcdef",
    "x" * 200_000 + ' api-key="' + A_SECRET + '"',
    "password" + " " * 50_000,
    '"' * 20_001,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    base = [s[:3] for s in secrets.spans(text) if s.kind != "literal"]
    assert base == base_by_hand(text or "")


@pytest.mark.parametrize(
    "text, found",
    [
        (f'db_pwd = "{A_SECRET}"', [A_SECRET]),
        (f"DB_PWD={A_SECRET}\n", [A_SECRET]),
        (f'{{"clientCredential": "{A_SECRET}"}}', [A_SECRET]),
        (f"part = '{A_SECRET}'\nauth_key = part", [A_SECRET]),
        ('a = "Zx81"\nb = a + "kPq7Lm2"\ndbPwd = b', ["Zx81", "kPq7Lm2"]),
        (f'credentials["{"pwd"}"] := "{A_SECRET}"', [A_SECRET]),
        (f'user_pwd: str = "{A_SECRET}"', [A_SECRET]),
        (f'pwd = """{A_SECRET}"""', [A_SECRET]),
        (f'colour = "{A_SECRET}"', []),
        (f'pwd_file = "{A_SECRET}"', []),
        ('pwd = "changeme"', []),
        ('pwd = "${DB_PWD}"', []),
        ("the pwd: something", []),
        (f'"api_pwd": "{A_SECRET}"\n"name": "bob the builder"', [A_SECRET]),
        (f'db_pwd = "{A_SECRET}"\n"""Connection helpers for the app."""', [A_SECRET]),
        (f'{{"db_pwd": "{A_SECRET}", "b": "other text"}}', [A_SECRET]),
        (f'  db_pwd = "{A_SECRET}"\n  "same depth 1"\n    "deeper 1"', [A_SECRET]),
        (f'pwd = (\n"{A_SECRET}"\n"tail99"\n)\nname = "x"', [A_SECRET, "tail99"]),
        (f'pwd = "{A_SECRET}" \\\n"tail99"', [A_SECRET, "tail99"]),
        (f'pwd = "{A_SECRET}" +\n"tail99"', [A_SECRET, "tail99"]),
        (f'pwd = "{A_SECRET}"\n    + "tail99"', [A_SECRET, "tail99"]),
        (f'api_pwd = KEY\nKEY = "{A_SECRET}"', [A_SECRET]),
        (f'pwd = A1\nA1 = B1 + "x9"\nB1 = C1\nC1 = "{A_SECRET}"', ["x9", A_SECRET]),
        (f'part = "{A_SECRET}"\npwd = part\npart = "other1"', [A_SECRET]),
        ('a = b\nb = a\npwd = a', []),
        (f'pwd = unknown + "{A_SECRET}"', [A_SECRET]),
        (f'set_pwd("{A_SECRET}")', [A_SECRET]),
        (f"client.withCredential( '{A_SECRET}' )", [A_SECRET]),
        (f'set_password("{A_SECRET}")', [A_SECRET]),
        (f'get_password("{A_SECRET}")', []),
        (f'tool --db-pwd {A_SECRET} --verbose', [A_SECRET]),
        (f'tool --db-pwd="{A_SECRET}"', [A_SECRET]),
        ("tool --pwd --verbose1Q", []),
        (f'Authorization: Bearer {A_SECRET}{A_SECRET}', [A_SECRET * 2]),
        ("the bearer responsibilities", []),
        (f'<db><pwd kind="x"> {A_SECRET} </pwd><name>{A_SECRET}</name></db>', [A_SECRET]),
        ('passphrase = "correct horse battery staple"', ["correct horse battery staple"]),
        ('auth = "a sentence of plain words"', []),
        (f'password = "{A_SECRET}"', []),  # the base span holds it
    ],
)
def test_literals_by_name(text, found):
    assert literals(text) == found


def test_names_that_double_each_other_end():
    lines = ['a0 = "Zx81kPq7Lm2"'] + [f"a{i} = a{i - 1} + a{i - 1}" for i in range(1, 200)]
    assert literals("\n".join([*lines, "my_pwd = a199"]))


def test_redaction_leaves_the_rest():
    text = f"one password=abcdefgh two AKIA{'Q' * 16} three"
    assert secrets.redacted(text, "#") == "one # two # three"
    assert secrets.redacted("plain", "#") == "plain"
    assert secrets.redacted(None, "#") is None


def test_frames(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], None, None), (None, "secret=abcdef", "x", "y")]
    docs = docs_table(spark, rows)
    found = secrets.digest(secrets.find_secrets(docs, ["doc_id", "secrets"])).collect()
    assert len(found) == len(rows)
    for r in found:
        text = "secret=abcdef" if r.doc_id is None else TEXTS[r.doc_id] or ""
        base = base_by_hand(text)
        form = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(form.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in base) for k in ("assign", "access", "hex"))
        assert r.spans == ",".join(f"{s.kind}:{s.start}:{s.end}" for s in secrets.spans(text))
    masked = secrets.redact(docs)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    assert secrets.digest(secrets.find_secrets(masked, ["doc_id"])).agg({"n_access": "sum"}).first()[0] == 0


def test_empty_table(spark):
    docs = docs_table(spark, [])
    assert secrets.digest(secrets.find_secrets(docs, ["doc_id"])).count() == 0
    assert secrets.redact(docs).count() == 0


def random_piece(i, n=16):
    return hashlib.sha256(str(i).encode()).hexdigest()[:n].upper()


def pem_lines(n):
    return [random_piece(i) for i in range(n)]


@pytest.mark.parametrize("glue", ["\n    ", " +\n    ", " "])
def test_every_piece_of_a_long_expression(glue):
    lines = pem_lines(400)
    text = "signing_pwd = " + glue.join(f'"{line}"' for line in lines) + "\nplain = 1\n"
    assert literals(text) == lines
    named = "last = 'Zx81kPq7Lm2'\nsigning_pwd = " + " + ".join([*(f'"{line}"' for line in lines), "last"])
    assert literals(named) == [A_SECRET, *lines]


def test_a_long_chain_of_names():
    lines = pem_lines(20_000)
    chain = [f'a0 = "{lines[0]}"'] + [f'a{i} = a{i - 1} + "{line}"' for i, line in enumerate(lines[1:], 1)]
    assert literals("\n".join([*chain, f"my_pwd = a{len(lines) - 1}"])) == lines


def test_one_letter_doubled():
    """Ever longer values of one letter carry no bits; the first other letter does."""
    lines = ['a0 = "x"'] + [f"a{i} = a{i - 1} + a{i - 1}" for i in range(1, 3000)]
    assert literals("\n".join([*lines, "my_pwd = a2999"])) == []
    assert literals("\n".join([*lines, 'my_pwd = a2999 + "Y"'])) == ["x", "Y"]


def test_strings_within_strings_stay_linear():
    secrets.spans("pwd = " + "\"a='\"'" * 50_000)


@pytest.mark.parametrize("name", ["bearer", "private_signing", "encryptionPrivate", "API_ACCESS"])
def test_names_of_any_weighted_word(name):
    assert literals(f'{name} = "{random_piece(1, 32)}"') == [random_piece(1, 32)]


@pytest.mark.parametrize("unit", ["a:", "TOKEN:", "pwd="])
def test_words_that_are_pairs_again_stay_linear(unit):
    secrets.spans(unit * 50_000)


def test_names_and_annotations_of_any_length():
    key = ".".join(["service", "v2"] * 30 + ["db", "pwd"])
    assert len(key) > 300
    assert literals(f'{key}: "{A_SECRET}"') == [A_SECRET]
    assert literals(f'{key}x = "{A_SECRET}"\nmy_pwd = {key}x') == [A_SECRET]
    assert literals(f'my_pwd: {key[:-7]}.Type = "{A_SECRET}"') == [A_SECRET]


@pytest.mark.parametrize("unit", ["a", "a.", "a:", '"a', "a ", "a: ", "a\t]"])
def test_long_names_stay_linear(unit):
    secrets.spans(unit * 200_000)


class Source:
    """Assignments made at random, their text, and what a plain recursion over them finds."""

    def __init__(self, seed):
        pick = random.Random(seed)
        names = ["db_pwd", "colour", "auth_key", "part", "head", "pwd_file", "client_credential", "tail", "salt"]
        made = [f"{n}{k}" for n in names for k in "AB"]
        order = made * 2
        pick.shuffle(order)
        self.rows, self.text = [], ""
        for line, name in enumerate(order[: pick.randint(3, 20)]):
            terms = []
            for _ in range(pick.randint(1, 3)):
                # Names refer to lines with a higher mark only, so that there are no circles.
                refer = [n for n in made if made.index(n) > made.index(name)]
                if refer and pick.random() < 0.5:
                    terms.append(("name", pick.choice(refer)))
                else:
                    terms.append(("text", "".join(pick.choice("abXY19_-") for _ in range(pick.randint(0, 9)))))
            begin = pick.choice(["", "  "]) + name + pick.choice([" = ", ": str = ", " := "])
            if begin.strip().endswith("str =") or pick.random() < 0.5:
                begin = begin.replace('": ', '" = ')
            self.text += begin
            places, split = [], pick.choice([" + ", " +\n", " \\\n  + "])
            for k, (kind, value) in enumerate(terms):
                self.text += split if k else ""
                places.append(len(self.text) + 1)
                self.text += value if kind == "name" else f'"{value}"'
            self.text += pick.choice(["\n", "\n\n", ";\n"])
            self.rows.append((name, [(*t, p) for t, p in zip(terms, places)]))

    def pieces(self, row, depth=0):
        """(place, text) of every literal that a row's value is made of, in order."""
        out = []
        for kind, value, place in self.rows[row][1]:
            if kind == "text":
                out.append((place, value))
                continue
            before = [i for i in range(row) if self.rows[i][0] == value]
            after = [i for i in range(row + 1, len(self.rows)) if self.rows[i][0] == value]
            if before or after:
                out += self.pieces(before[-1] if before else after[0], depth + 1)
            elif len(self.rows[row][1]) == 1:
                out.append((place - 1, value))
        return out

    def found(self):
        spans = set()
        for k, (name, _) in enumerate(self.rows):
            pieces = self.pieces(k)
            whole = "".join(t for _, t in pieces)
            quoted = any(self.text[p - 1] == '"' for p, _ in pieces)
            value = secrets._value(whole, 0, len(whole), quoted)
            if whole and max(secrets.name_score(name), 0) * secrets.literal_score(value) >= secrets.SCORE:
                spans |= {(p, p + len(t)) for p, t in pieces if t}
        return spans


def test_literals_against_a_plain_recursion():
    hits = 0
    for seed in range(400):
        source = Source(seed)
        base = {s[:3] for s in secrets.spans(source.text) if s.kind != "literal"}
        inside = {(a, b) for a, b in source.found() if not any(x <= a and b <= y for _, x, y in base)}
        got = {(s.start, s.end) for s in secrets.literal_spans(source.text)}
        assert got == source.found(), (seed, source.text)
        assert {(s.start, s.end) for s in secrets.spans(source.text) if s.kind == "literal"} == inside
        hits += len(got)
    assert hits > 300
