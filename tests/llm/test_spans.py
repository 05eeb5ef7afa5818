"""Secrets, licenses and personal data against plain versions of their rules."""

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from refinery.llm import licenses, private, secrets

SECRET_PARTS = ["token", "Api_Key", "password", " = ", ": ", '"', "'", "abc", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "-", " ", "é", "\n", "9f"]
PRIVATE_PARTS = ["a.b", "@", "x-1", ".com", "1", "23", ".", "255", "256", "4111 1111 1111 1111", "-", " ", "+", "(0", ") ", "é", "\n"]


def texts(parts):
    return st.lists(st.sampled_from(parts), max_size=30).map("".join)


@settings(max_examples=400, deadline=None)
@given(texts(SECRET_PARTS))
def test_base_secrets(text):
    assign = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
    )
    want = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    want += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    want += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    assert sorted(secrets.base_secrets(text)) == sorted(want)
    found = secrets.find_secrets(text)
    assert [s[:3] for s in found if s[3]] == sorted(want, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


@settings(max_examples=200, deadline=None)
@given(st.text("ab01ZX+", min_size=1, max_size=60), st.integers(2, 24), st.floats(0.5, 4))
def test_windows_against_counting_each_anew(text, window, bits):
    n = min(window, len(text))
    hot = set()
    for start in range(len(text) - n + 1):
        counts = Counter(text[start : start + n]).values()
        entropy = -sum(c / n * math.log2(c / n) for c in counts)
        if entropy >= bits + 1e-6:
            hot |= set(range(start, start + n))
        elif abs(entropy - bits) <= 1e-6:
            return
    spans = secrets.hot_windows(text, window, bits)
    assert set().union(*(range(a, b) for a, b in spans)) == hot
    assert all(spans[k][1] < spans[k + 1][0] for k in range(len(spans) - 1))


def test_entropy_finds_what_no_rule_names_and_leaves_words_and_allowed_strings():
    key = "Zk3vQ9xTm2LrB8nWc5YhJ7pD4sGfA1eK6uH0"
    spans = secrets.find_secrets(f"see {key} now")
    assert [(s[0], s[3]) for s in spans] == [("entropy_base64", False)]
    assert "see "[:4] and spans[0][1] >= 4 and spans[0][2] <= 4 + len(key)
    for quiet in (
        "internationalization_of_everything_with_underscores_and_more",
        "id 123e4567-e89b-12d3-a456-426614174000 end",
        "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
        "0000000000000000000000000000000000000000000A",
    ):
        assert not [s for s in secrets.find_secrets(quiet) if not s[3]], quiet


def test_a_key_beside_a_hash_or_an_allowed_string_in_one_run():
    key = "Zk3vQ9xTm2LrB8nWc5YhJ7pD4sGfA1eK6uH0wXqR"
    for other in ("0123456789abcdef0123456789abcdef", "123e4567-e89b-12d3-a456-426614174000"):
        for text in (f"{other}/{key}", f"{key}/{other}"):
            spans = [(a, b) for _, a, b, base in secrets.find_secrets(text) if not base]
            assert [text[a:b].strip("/") for a, b in spans] == [key]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


@settings(max_examples=600, deadline=None)
@given(texts(PRIVATE_PARTS))
def test_base_private(text):
    want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        want += [("ip", *m.span())] * all(int(p) <= 255 for p in m[0].split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        want += [("card", *m.span())] * (14 <= len(digits) <= 19 and luhn(digits))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        want += [("phone", *m.span())] * (10 <= sum(map(str.isdigit, m[0])) <= 15)
    assert sorted(private.identifiers(text)) == sorted(want)
    assert [s[:3] for s in private.find_private(text) if s[3]] == sorted(
        want, key=lambda s: (s[1], private.KINDS.index(s[0]), s[2])
    )


@pytest.mark.parametrize(
    ("text", "kind", "said"),
    [
        ("write to jane [at] example [dot] com please", "email", "jane [at] example [dot] com"),
        ("write to jane at example dot com please", "email", "jane at example dot com"),
        ("jane (arroba) example (punto) com", "email", "jane (arroba) example (punto) com"),
        ("mail jаne@example.com now", "email", "jаne@example.com"),
        ("mail ｊａｎｅ＠example.com now", "email", "ｊａｎｅ＠example.com"),
        ("call plus one two one two five five five zero one nine nine today", "phone",
         "plus one two one two five five five zero one nine nine"),
        ("host one nine two dot one six eight dot one dot one up", "ip", "one nine two dot one six eight dot one dot one"),
        ("ip 10​.0.0.1 here", "ip", "10​.0.0.1"),
    ],
)
def test_disguises_are_found_and_mapped_back(text, kind, said):
    spans = private.find_private(text)
    assert ("hidden_" + kind, said) in [(k, text[a:b]) for k, a, b, _ in spans]


def test_at_before_a_plain_domain():
    text = "write to jane at example.com please"
    assert [(k, text[a:b]) for k, a, b, _ in private.find_private(text)] == [("hidden_email", "jane at example.com")]


SIGN_PARTS = ["jane", "x", " ", " ", "\u2003", " at ", " AT", "chez", "arroba ", "dot", " Punkt ", "punto", ".", "com", "@", "[", "]", "(", ")", "<", "-", "é", "\n"]


@settings(max_examples=1500, deadline=None)
@given(texts(SIGN_PARTS))
def test_the_shortcut_for_written_signs_loses_none(text):
    assert private.written_signs(text) == private.all_signs(text)


@pytest.mark.parametrize(
    "text",
    ["we meet at noon. The dot is red", "look at the one two punch", "un deux trois, quatre amis", "a – b at c", ""],
)
def test_plain_prose_is_left_alone(text):
    assert private.find_private(text) == []
    assert private.mask(text) == text


def test_masks():
    assert private.mask("a x@y.zz b 10.0.0.1") == "a [EMAIL] b [IP]"
    assert private.mask("jane [at] example [dot] com!", {"email": "<e>"}) == "<e>!"


def test_long_runs_stay_fast():
    private.find_private("a" * 300_000 + "@" + "1" * 300_000 + " " + "9." * 100_000)
    secrets.find_secrets("f" * 300_000 + " " + "token=" * 20_000)
    licenses.find_licenses("mit license " * 50_000, licenses.PassageIndex([], {}, 0.8))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


@settings(max_examples=300, deadline=None)
@given(texts(["MIT", "mit", " ", "license", "License.", "apache", "general", "public", "-", "é", "[", "9"]))
def test_license_phrases(text):
    n_words, hits = licenses.find_licenses(text, licenses.PassageIndex([], {}, 0.8))
    w = words(text)
    want = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        want += [(label, k) for k in range(len(w)) if w[k : k + len(p)] == p]
    assert n_words == len(w)
    assert sorted((label, k) for label, k, base, _ in hits if base) == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefghijk"), max_size=40), st.lists(st.sampled_from("abcdefgxyz"), min_size=1, max_size=8))
def test_blocks_against_trying_every_passage(text, passage):
    found = licenses.passages({"one": [" ".join(passage)], "two": ["a b c d"]}, most=8)
    index = licenses.PassageIndex(found, Counter(text_word.encode() for text_word in text), 0.8)
    _, hits = licenses.find_licenses(" ".join(text), index, {}, half=8)
    want = set()
    for start in range(-8, len(text), 8):
        block = {w.encode() for w in text[max(0, start) : start + 16]}
        for p in found:
            if p.words and len(p.words & block) >= math.ceil(0.8 * len(p.words) - 1e-9):
                want.add(p.label)
    assert {label for label, *_ in hits} == want


def test_every_place_of_a_passage_is_a_hit():
    one, two = " ".join(f"p{k}" for k in range(20)), " ".join(f"q{k}" for k in range(20))
    found = licenses.passages({"one": [one, two]})
    filler = " ".join(f"x{k}" for k in range(108))
    _, hits = licenses.license_hits(f"{one} {filler} {one} {filler} {two}", licenses.PassageIndex(found, {}, 0.8), {})
    assert [(h.label, h.passage, h.word, h.base, h.containment) for h in hits] == [
        ("one", 0, 0, False, 1.0), ("one", 0, 96, False, 1.0), ("one", 1, 224, False, 1.0)
    ]


def method_labels(text):
    found = licenses.passages(licenses.LICENSES)
    index = licenses.PassageIndex(found, {}, 0.8, in_order_below=licenses.IN_ORDER_BELOW, telling=licenses.TELLING)
    return {h.label for h in licenses.license_hits(text, index)[1] if not h.base}


@pytest.mark.parametrize(
    "text",
    [
        "Released under the GNU General Public License version 2.",
        "The film was released under the new label with a license to distribute.",
        "licensed under terms set by section 4 part 0 of the act",
        "by the license released by cc 4 0 under a licensed version of the mit",
        "",
    ],
)
def test_common_turns_of_phrase_are_no_license(text):
    assert method_labels(text) == set()


@pytest.mark.parametrize("label", licenses.LICENSES)
def test_a_license_gets_its_own_label_only(label):
    for text in [*licenses.LICENSES[label], " ".join(licenses.LICENSES[label])]:
        assert method_labels(text) == {label}
        assert method_labels(f"Some words before it. {text.upper()} And {'more ' * 50}") == {label}


def test_an_altered_notice_is_still_told():
    text = licenses.LICENSES["mit"][0].replace("any person", "anyone").replace("the Software", "our program")
    assert method_labels(text) == {"mit"}


def disguises():
    """(kind, disguised text) by rule: every way of writing for every identifier."""
    digits = {"arabic": 0x660, "devanagari": 0x966, "wide": 0xFF10, "bold": 0x1D7CE, "bengali": 0x9E6}
    spelled = "zero one two three four five six seven eight nine".split()
    numbers = {"ip": "192.168.10.77", "card": "4111 1111 1111 1111", "phone": "+49 30 1234567"}
    for kind, plain in numbers.items():
        for start in digits.values():
            yield kind, "".join(chr(start + int(c)) if c.isdigit() else c for c in plain)
        yield kind, plain.replace("1", "&#49;")
        yield kind, "\u200b".join(plain)
    yield "ip", " dot ".join(" ".join(spelled[int(c)] for c in part) for part in numbers["ip"].split("."))
    yield "card", " ".join(spelled[int(c)] for c in numbers["card"].replace(" ", ""))
    yield "phone", "plus " + " ".join(spelled[int(c)] for c in numbers["phone"][1:].replace(" ", ""))
    ats = [" at ", " [at] ", "(at)", " {at} ", " <at> ", " _at_ ", "_at_", " AT ", " @ ", "&#64;", "&#x40;", "&commat;", "\uff20", "[@]"]
    dots = [" dot ", " [dot] ", "(dot)", " _dot_ ", "_dot_", " DOT ", "&#46;", "&period;", "\u2024", "."]
    for at in ats:
        for dot in dots:
            if (at, dot) != ("_at_", ".") and (at == "_at_") <= ("_" in dot):
                yield "email", f"jane{at}example{dot}com"
    for name in ("j\u0430ne@example.com", "jane@\u0501omain.com", "jane@ex\u0430mple.c\u043em", "\uff4aane@example.com", "ja\u200bne@example.com"):
        yield "email", name


def test_recall_of_disguises_by_kind():
    found, total = Counter(), Counter()
    for kind, said in disguises():
        text = f"Please write to {said} today, thanks."
        total[kind] += 1
        spans = [text[a:b] for k, a, b, base in private.find_private(text) if k == "hidden_" + kind]
        found[kind] += any(said in span or span in said and len(span) > 0.6 * len(said) for span in spans)
    assert set(total) == {"email", "ip", "card", "phone"} and total["email"] > 100
    assert all(found[kind] >= 0.9 * total[kind] for kind in total), (found, total)


@pytest.mark.parametrize(
    "text",
    [
        "Look_at_this.that and meet me at the big dot of the map at noon. Tom & Jerry &amp; friends &#169; 2024.",
        "We were at home; she looked at it. The year \u0662\u0660\u0662\u0664 was long \u2014 at least for some.",
        "snake_case_at_work and data_dot_com are names; five six seven people came at 10.30 to www.example.com",
    ],
)
def test_prose_and_code_are_left_alone(text):
    assert private.find_private(text) == []
