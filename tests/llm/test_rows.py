"""Quality rules, secrets, pseudonyms and chats: hand-made cases and brute force."""

from __future__ import annotations

import base64
import hashlib
import itertools
import json
import re
import time

import pytest

from millrace.llm import chat, pseudonyms, quality_rules, secret_scan
from millrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"

CLEAN = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for queen jack"
TEXTS = [
    None, "", " \n\t ", "one two", CLEAN, CLEAN.upper(), CLEAN.replace(" ", " | "), f"{CLEAN}\n" * 4,
    " ".join(["a b c d e f"] * 9), "é\xa0à " * 12, "x\x85y z\n" * 3, "\n".join(["- item and word"] * 20),
    " ".join(f"w{i:b}".replace("0", "o").replace("1", "l") for i in range(3000)), "wow! so! much! fun! here! we! all! go! now! then!", "1 2 3 4 5 6 7 8 9 10 11 12",
    "a" * 50_000,
]


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, gram in enumerate(grams) if grams.count(gram) > 1 for k in range(5)} if len(grams) < 2000 else set()
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(docs):
    rows = quality_rules.quality_cascade(docs(list(enumerate(TEXTS))), ordered=True).orderBy("doc_id").collect()
    got = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows]
    assert got == [brute_counts(text) for text in TEXTS]
    kept = {r.doc_id for r in rows if r.kept}
    assert {4, 12} <= kept and not kept & {0, 1, 2, 3, 5, 6, 7, 8, 11, 13, 14, 15}
    assert all((r.failed_rule is None) == r.kept for r in rows)


def test_order_does_not_decide(docs):
    table = docs([(i, text) for i, text in enumerate(TEXTS * 3)])
    forward = quality_rules.quality_cascade(table, quality_rules.RULES, ordered=True)
    backward = quality_rules.quality_cascade(table, quality_rules.RULES[::-1], ordered=True)
    measured = quality_rules.quality_cascade(table)
    views = [sorted((r.doc_id, r.kept) for r in frame.collect()) for frame in (forward, backward, measured)]
    assert views[0] == views[1] == views[2]


def test_rules_are_ordered_by_rejections_per_second(docs):
    rules = [quality_rules.Rule("never", lambda: quality_rules.F.lit(False)),
             quality_rules.Rule("often", lambda: quality_rules.F.length("text") > 2)]
    counted = docs([(i, CLEAN) for i in range(50)])
    assert [rule.name for rule in quality_rules.order_rules(counted, rules, share=1.0)] == ["often", "never"]


def test_quality_of_an_empty_table(docs):
    assert quality_rules.quality_cascade(docs([(1, "a")]).limit(0)).count() == 0


# Secrets

def der(tag: int, data: bytes) -> bytes:
    size = bytes([len(data)]) if len(data) < 128 else bytes([0x82]) + len(data).to_bytes(2, "big")
    return bytes([tag]) + size + data


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([1 + i]) * 40) for i in range(8)))
PKCS8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, b"k" * 32)))
SSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"".join(
    len(x).to_bytes(4, "big") + x for x in (b"public" * 5, b"private" * 9))


def b64url(data: bytes) -> str:
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


JWT = ".".join([b64url(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()), b64url(b'{"sub":"1"}'), b64url(b"s" * 32)])


def kinds(text):
    return [(k, text[a:b]) for k, a, b, _ in secret_scan.find_secrets(text)]


def test_base_patterns():
    assert kinds('password = "hunter22" x') == [("assign", 'password = "hunter22')]
    assert kinds("PassWd:abc secret: token: abcdefgh") == []
    assert kinds("\u017fecret: abcdefgh to\u212aen: abcdefgh") == []
    assert kinds("api-key api_key='abcdefg' apikey==abcdef") == [("assign", "api_key='abcdefg"), ("assign", "apikey==abcdef")]
    assert kinds("AKIA" + "Q" * 15) == [] and kinds("AKIA" + "Q" * 16) == [("access", "AKIA" + "Q" * 16)]
    assert kinds("é" + "0123456789abcdef" * 2) == [("hex", "0123456789abcdef" * 2)]
    assert kinds("a" * 23) == []


@pytest.mark.parametrize("kind, text", [
    ("jwt", JWT), ("der", base64.b64encode(RSA).decode()), ("der", base64.b64encode(PKCS8).decode()), ("der", PKCS8.hex().upper()),
    ("ssh", base64.b64encode(SSH).decode()),
    ("pem", "-----BEGIN PRIVATE KEY-----\n" + base64.encodebytes(PKCS8).decode() + "-----END PRIVATE KEY-----"),
])
def test_structure_confirms(kind, text):
    assert (kind, text) in kinds(f"see {text} there")


PEM, PEM_SSH = (f"-----BEGIN {name}-----\n{base64.encodebytes(data).decode()}-----END {name}-----"
                for name, data in (("RSA PRIVATE KEY", RSA), ("OPENSSH PRIVATE KEY", SSH)))


@pytest.mark.parametrize("pem", [PEM, PEM_SSH])
def test_armour_in_other_clothes(pem):
    """Escaped line ends, once and twice, escaped slashes, and the block encoded as a whole."""
    clothes = [pem.replace("\n", end) for end in ("\r\n", "\\n", "\\r\\n", "\\\\n", "\\u000a", "\\\n")]
    clothes += [json.dumps(pem)[1:-1].replace("/", "\\/"), base64.b64encode(pem.encode()).decode(), b64url((pem + "\n").encode())]
    for text in clothes:
        assert ("pem", text) in kinds(f'{{"key": "{text}"}}'), text
    broken = pem.replace("M", "", 1).replace("b3", "", 1)
    for text in (broken.replace("\n", "\\n"), base64.b64encode(broken.encode()).decode()):
        assert not [k for k, _ in kinds(f'"{text}"') if k == "pem"]


@pytest.mark.parametrize("text", [
    *["-----BEGIN PRIVATE KEY-----" + body + "-----END PRIVATE KEY-----" for body in ("\\" * 1_000_000, "\\r" * 500_000, "\\" * 500_000 + "r" + "\\" * 500_000)],
    *[part * (1_000_000 // len(part)) for part in ("e", "M", "A", "30", "0x30", "eaaaaaaa.", "-----BEGIN ", "LS0t", "token=", "AKIA", "a.b-")]])
def test_long_runs_take_linear_time(text):
    begin = time.process_time()
    secret_scan.find_secrets(text)
    assert time.process_time() - begin < 5


def test_hexadecimal_with_prefix():
    for data, kind in ((PKCS8, "der"), (SSH, "ssh")):
        for text in (data.hex(), data.hex().upper()):
            assert (kind, text) in kinds(f"key=0x{text};") and (kind, text) in kinds(f"0X{text}")
            assert kind not in {k for k, _ in kinds(f"10x{text}")}


@pytest.mark.parametrize("text", [
    JWT.replace("ey", "aa", 1), ".".join([b64url(b'{"typ":"x"}'), *JWT.split(".")[1:]]), base64.b64encode(RSA[:-1]).decode(),
    base64.b64encode(RSA + b"x").decode(), base64.b64encode(SSH[:-3]).decode(), "M" + "A" * 60,
    "-----BEGIN PRIVATE KEY-----\nAAAA\n-----END PRIVATE KEY-----", "www.example.org", "e" * 40 + ".ab.cd",
])
def test_structure_refuses(text):
    assert not [k for k, _ in kinds(text) if k not in secret_scan.BASE_KINDS]


def test_secrets_of_odd_rows(docs):
    rows = secret_scan.scan_secrets(docs([(1, None), (None, ""), (2, "token=abcdefgh"), (2, "token=abcdefgh")])).collect()
    assert sorted(len(r.spans) for r in rows) == [0, 0, 1, 1]
    assert secret_scan.scan_secrets(docs([(1, "a")]).limit(0)).count() == 0


def test_secret_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for r in QUERIES["op5_secret_scan"](spark, FOLDER).collect():
        text = texts.pop(r.doc_id)
        spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        base = ",".join(s for *_, s in sorted(spans))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(r.spans.split(","))
    assert not texts


# Pseudonyms

P = pseudonyms.Permutation("key")


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 1000])
def test_permutation(size):
    assert sorted(P.below(i, size, "x") for i in range(size)) == list(range(size))


@pytest.mark.parametrize("text, shape", [
    ("4539 1488 0343 6467", r"\d{4} \d{4} \d{4} \d{4}"), ("4539148803436467", r"\d{16}"), ("+1 (389) 555-5010", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
    ("jo.doe+x7@mail2.example.com", r"[a-z]{2}\.[a-z]{3}\+[a-z]\d@[a-z]{4}\d\.[a-z]{7}\.com"), ("123-45-6789", r"\d{3}-\d{2}-\d{4}"),
    ("233.254.104.120", r"\d{1,3}(\.\d{1,3}){3}"), ("2021-02-28", r"\d{4}-\d{2}-\d{2}"), ("28.02.2021", r"\d{2}\.\d{2}\.\d{4}"),
    ("GB82 WEST 1234 5698 7654 32", r"GB\d{2} [A-Z]{4} \d{4} \d{4} \d{4} \d{2}"),
])
def test_formats_stay(text, shape):
    new, spans = pseudonyms.pseudonymise(f"Say {text}, {text}!", P)
    found = [new[a:b] for _, a, b in spans]
    assert len(found) == 2 and found[0] == found[1] != text and re.fullmatch(shape, found[0])
    kind = spans[0][0]
    again, _ = pseudonyms.pseudonymise(found[0], P)
    assert re.fullmatch(shape, again), f"a pseudonym is a valid {kind} itself"
    assert pseudonyms.pseudonymise(text, pseudonyms.Permutation("other"))[0] != found[0]


@pytest.mark.parametrize("text", ["9807915762804490", "000-12-3456", "2021-02-30", "300.1.2.3", "GB82 WEST 1234 5698 7654 33", "no@body", "3.", "Version 2.0."])
def test_invalid_stays(text):
    assert pseudonyms.pseudonymise(f"a {text} b", P) == (f"a {text} b", [])


def test_neighbouring_numbers():
    two = "7536784127813050 4845168114407329"
    new, _ = pseudonyms.pseudonymise(f"x {two} 12 y", P)
    one, other = (pseudonyms.pseudonymise(part, P)[0] for part in two.split())
    assert new == f"x {one} {other} 12 y"


PRIVATE = [
    ("email", "jo.doe@mail.example.com"), ("card", "4539148803436467"), ("card", "4539 1488 0343 6467"), ("iban", "AT61 1904 3002 3457 3201"),
    ("iban", "ES91 2100 0418 4502 0005 1332"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("ssn", "123-45-6789"), ("phone", "555-123-4567"),
    ("phone", "+44 20 7946 0958"), ("ip", "10.0.0.1"), ("date", "2024-05-06"), ("date", "28.02.2021"),
]


@pytest.mark.parametrize("kind, value", PRIVATE)
@pytest.mark.parametrize("before, after", [("Room 7", "x"), ("Order 4411", "PAY now"), ("node 12", "BANK 9"), ("AB12 2024", "DUE TODAY")])
def test_neighbours_hide_nothing(kind, value, before, after):
    """Numbers before and capital words after a value are no part of it."""
    alone = pseudonyms.pseudonymise(value, P)[0]
    new, spans = pseudonyms.pseudonymise(f"{before} {value} {after}", P)
    assert new == f"{before} {alone} {after}" and [k for k, *_ in spans] == [kind]


@pytest.mark.parametrize("kind, value", PRIVATE)
@pytest.mark.parametrize("other, neighbour", PRIVATE)
def test_neighbouring_values(kind, value, other, neighbour):
    new, spans = pseudonyms.pseudonymise(f"x {value} {neighbour} y", P)
    assert new == f"x {pseudonyms.pseudonymise(value, P)[0]} {pseudonyms.pseudonymise(neighbour, P)[0]} y"
    assert [k for k, *_ in spans] == [kind, other] and [new[a:b] for _, a, b in spans][0] in new


@pytest.mark.parametrize("n", [4, 5, 50])
def test_long_rows_of_cards(n):
    """No window cuts through a number of a long row."""
    card = "4539 1488 0343 6467"
    alone = pseudonyms.pseudonymise(card, P)[0]
    new, spans = pseudonyms.pseudonymise(" ".join([card] * n), P)
    assert new == " ".join([alone] * n) and len(spans) == n


def test_pseudonyms_of_odd_rows(docs):
    table = docs([(1, None), (None, ""), (2, "ip 10.0.0.1"), (3, "10.0.0.1 ip"), (2, "ip 10.0.0.1"), (4, "z" * 300_000)]).withColumnRenamed("lang", "pii")
    rows = pseudonyms.replace_private(table, "key").collect()
    assert {len(r.pii) for r in rows if r.doc_id in (2, 3)} == {1} and len(rows) == 6
    assert len({re.search(r"[\d.]{7,}", r.text).group() for r in rows if r.doc_id in (2, 3)}) == 1
    assert [r.text for r in rows if r.doc_id in (1, None)] == [None, ""]
    assert pseudonyms.replace_private(table.limit(0), "key").count() == 0


def test_private_query(spark):
    """Whatever is valid has gone from its document, whatever is not is still there."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}

    def luhn(digits):
        return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0

    gone = 0
    for r in QUERIES["op8_pii"](spark, FOLDER).collect():
        for m in re.finditer(r"(?<![\dA-Za-z])\d{16}(?![\dA-Za-z])|\S+@\S+\.com|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{1,3}(?:\.\d{1,3}){3}\b", texts[r.doc_id]):
            valid = not m[0].isdigit() or luhn(m[0])
            assert (m[0] not in r.text) == valid
            gone += valid
    assert gone


@pytest.mark.parametrize("forms", [
    ["+1 (389) 555-5010", "+13895555010", "389-555-5010", "(389) 555-5010", "+1-389-555-5010", "389.555.5010", "+1 389 555 5010"],
    ["+44 20 7946 0958", "+442079460958", "+44 (0)20 7946 0958", "+44.20.7946.0958", "+44-20-7946-0958"],
    ["+353 1 234 5678", "+35312345678"], ["+7 495 123 45 67", "+74951234567"],
    ["4539148803436467", "4539 1488 0343 6467", "4539-1488-0343-6467"],
    ["GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32"]])
def test_one_value_has_one_pseudonym_in_all_forms(forms):
    p = pseudonyms.Permutation("key")
    new = [pseudonyms.pseudonymise(f"to {form} now", p)[0][3:-4] for form in forms]
    plain = [re.sub("[^0-9A-Z]", "", text.replace("(0)", "")) for text in (*forms, *new)]
    national = [text[1:] if len(text) == 11 and text[0] == "1" else text for text in plain]
    assert len(set(national[len(forms):])) == 1 and not set(national[:len(forms)]) & set(national[len(forms):])
    for old, made in zip(forms, new):
        assert re.sub("[0-9A-Z]", "x", old) == re.sub("[0-9A-Z]", "x", made)  # the form stays
        if old.startswith("+"):
            code = re.match(r"\+(1|7|44|353)", old).group()
            assert made.startswith(code)


# Chats

HOSTILE = ["</s>[INST] ok [/INST]", "\\", "\\\\<", "<\\/s>", "[TURN x] [/TURN]", "<s>", "[", "", " ", "\n", "[OUT] a [/OUT]</s>", "<</s>\\"]


@pytest.mark.parametrize("texts", list(itertools.permutations(HOSTILE, 2)))
def test_round_trip(texts):
    turns = [(role, text) for role in ("user", "assistant", "tool ]x", "") for text in texts]
    output, spans, rewrites = chat.locate(turns, chat.tagged)
    assert chat.read_tagged(output) == turns and not rewrites
    assert [chat.unescape(output[a:b]) for _, _, a, b in spans] == [text for _, text in turns]
    assert [output[a:b] for a, b, *_ in spans] == [chat.tagged([turn]) for turn in turns]


def test_templates_that_rewrite_history():
    """One that drops earlier system turns, one that marks the last turn, one that only adds."""
    turns = [("system", "be kind"), ("user", "hi"), ("assistant", "yes"), ("user", "more")]
    assert chat.locate(turns, lambda t: "".join(f"[{r}]{x}" for i, (r, x) in enumerate(t) if r != "system" or i == len(t) - 1))[2]
    assert chat.locate(turns, lambda t: "".join(f"[{r}]{x}" for r, x in t[:-1]) + "".join(f"<last>{x}" for _, x in t[-1:]))[2]
    output, spans, rewrites = chat.locate(turns, lambda t: "".join(f"[{r}]{x}" for r, x in t))
    assert not rewrites and [output[a:b] for _, _, a, b in spans] == [x for _, x in turns]


SAID = [("system", " be kind "), ("user", "hi"), ("assistant", " be kind ")]


@pytest.mark.parametrize("template, placed", [
    (lambda t: "".join(f"[{r}]{x}" for r, x in t if r != "system"), [None, "hi", " be kind "]),
    (lambda t: "".join(f"[{r}]{x}|{x}" for r, x in t), [None, None, None]),
    (lambda t: "".join(f"[{r}]{x.strip()}" for r, x in t), ["be kind", "hi", "be kind"]),
    (lambda t: "".join(f"[{r}]{x.upper()}." for r, x in t), [" BE KIND ", "HI", " BE KIND "]),
    (lambda t: "".join(f"[{r}]{len(x)}" for r, x in t), [None, None, None]),
    (lambda t: "".join(f"[{r}]{x}" + "!" * (len(x) > 5) for r, x in t), [" be kind !", "hi", " be kind !"]),
    (lambda t: "".join(f"[{r}]{x if len(x) > 1 else 'short ' + x}" for r, x in t), [None, None, None])])
def test_texts_without_a_place_are_marked(template, placed):
    """Templates that drop, repeat, trim, change, count or decorate a text, or treat short ones otherwise: what the
    template wrote for a text is located, or marked as having no place."""
    output, spans, rewrites = chat.locate(SAID, template)
    assert not rewrites and [a if a is None else output[a:b] for _, _, a, b in spans] == placed


def test_a_template_that_moves_texts_rewrites_history():
    assert chat.locate(SAID, lambda t: "".join(x for _, x in t[-1:]) + "".join(f"[{r}]" for r, _ in t))[2]


def test_a_turn_without_a_place_is_not_learnt(spark):
    table = spark.createDataFrame([(1, n, role, text) for n, (role, text) in enumerate(SAID)], "conv_id long, turn long, role string, text string")
    row = chat.format_chats(table, lambda t: "".join(f"[{r}]{x}|{x}" for r, x in t)).first()
    assert row.unplaced == 3 and not any(s.loss for s in row.spans) and all(s.text_start is None for s in row.spans)
    assert chat.format_chats(table).first().unplaced == 0


def test_chats_of_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, None, None), (None, 0, "user", "x"), (2, 0, "user", "same"), (2, 0, "user", "same")]
    table = spark.createDataFrame([(*r, "z", "y") for r in rows], "conv_id long, turn long, role string, text string, formatted string, spans string")
    found = {r.conv_id: chat.read_tagged(r.formatted) for r in chat.format_chats(table).collect()}
    assert found == {1: [("", ""), ("user", "a"), ("assistant", "b")], None: [("user", "x")], 2: [("user", "same")] * 2}
    assert chat.format_chats(table.limit(0)).count() == 0


def test_chat_query(spark):
    want = {-1: [("user", HOSTILE[0]), ("assistant", HOSTILE[0])]}
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    for r in QUERIES["op9_chat_format"](spark, FOLDER).collect():
        turns = want.pop(r.conv_id)
        learnt = "".join(text for role, text in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(learnt) and not r.rewrites
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    assert not want
