"""Stems of German, Spanish and French words by the published Snowball algorithms.

A step names endings, longest first, the region in which an ending must lie, and what becomes of it; one engine finds
the ending. Regions are offsets: R1 begins after the first consonant that follows a vowel, R2 likewise within R1.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

# Vowels and endings of the published algorithms.
VOWELS = {"de": "aeiouyäöü", "es": "aeiouáéíóúü", "fr": "aeiouyâàëéêèïîôûù"}
DE_1, DE_2, DE_3 = "em ern er e en es s", "en er est st", "end ung ig ik isch lich heit keit"
DE_S, DE_ST = "bdfghklmnrt", "bdfghklmnt"
ES_PRONOUNS = "me se sela selo selas selos la le lo las les los nos"
ES_BARE = "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos"
ES_IC = "adora ador ación adoras adores aciones ante antes ancia ancias acion"
ES_Y = "ya ye yan yen yeron yendo yo yó yas yes yais yamos"
ES_GU = "en es éis emos"
ES_VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré "
    "aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais "
    "arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos"
)
FR_BARE = "ance iqUe isme able iste eux ances iqUes ismes ables istes"
FR_IC = "atrice ateur ation atrices ateurs ations"
FR_I_VERBS = "îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent issais issait issant issante issantes issants isse issent isses issez issiez issions issons it"
FR_E_VERBS = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez"
FR_A_VERBS = "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions"


@cache
def _endings(names: str) -> tuple[str, ...]:
    return tuple(sorted(names.split(), key=len, reverse=True))


def _longest(word: str, names: str, least: int = 0) -> str:
    """The longest of these endings that the word has from an offset on; '' if it has none."""
    return next((e for e in _endings(names) if word.endswith(e) and len(word) - len(e) >= least), "")


def _region(word: str, vowels: str, start: int = 0) -> int:
    """The offset after the first consonant that follows a vowel."""
    for k in range(start + 1, len(word)):
        if word[k] not in vowels and word[k - 1] in vowels:
            return k + 1
    return len(word)


def _cut(word: str, ending: str, least: int) -> str | None:
    """The word without an ending that lies in a region; None if it isn't there."""
    return word[: len(word) - len(ending)] if word.endswith(ending) and len(word) - len(ending) >= least else None


def german(word: str) -> str:
    v = VOWELS["de"]
    word = word.replace("ß", "ss")
    word = "".join(c.upper() if c in "uy" and 0 < k < len(word) - 1 and word[k - 1] in v and word[k + 1] in v else c for k, c in enumerate(word))
    r1 = _region(word, v)
    r2 = _region(word, v, r1)
    r1 = max(r1, 3)
    e = _longest(word, DE_1)
    if e and len(word) - len(e) >= r1 and (e != "s" or word[-2] in DE_S):
        word = word[: -len(e)]
        if e in ("e", "en", "es") and word.endswith("niss"):
            word = word[:-1]
    e = _longest(word, DE_2)
    if e and len(word) - len(e) >= r1 and (e != "st" or len(word) >= 6 and word[-3] in DE_ST):
        word = word[: -len(e)]
    e = _longest(word, DE_3)
    if e and len(word) - len(e) >= r2:
        rest = word[: -len(e)]
        if e in ("end", "ung"):
            word = rest
            if (shorter := _cut(word, "ig", r2)) is not None and not shorter.endswith("e"):
                word = shorter
        elif e in ("ig", "ik", "isch"):
            word = word if rest.endswith("e") else rest
        elif e in ("lich", "heit"):
            word = next((c for x in ("er", "en") if (c := _cut(rest, x, r1)) is not None), rest)
        else:
            word = next((c for x in ("lich", "ig") if (c := _cut(rest, x, r2)) is not None), rest)
    return word.lower().translate(str.maketrans("äöü", "aou"))


def spanish(word: str) -> str:
    v = VOWELS["es"]
    r1 = _region(word, v)
    r2 = _region(word, v, r1)
    rv = len(word)
    if len(word) > 2:
        if word[1] not in v:
            rv = next((k + 1 for k in range(2, len(word)) if word[k] in v), len(word))
        elif word[0] in v:
            rv = next((k + 1 for k in range(2, len(word)) if word[k] not in v), len(word))
        else:
            rv = 3
    plain = str.maketrans("áéíóú", "aeiou")

    e = _longest(word, ES_PRONOUNS)
    if e and len(word) - len(e) >= rv:
        stem = word[: -len(e)]
        if x := _longest(stem, "iéndo ándo ár ér ír", rv):
            word = stem[: -len(x)] + x.translate(plain)
        elif _longest(stem, "ando iendo ar er ir", rv) or _longest(stem, "yendo", rv) and stem[:-5].endswith("u"):
            word = stem

    def first() -> str | None:
        """What the first step leaves, or None if it changes nothing."""
        groups = f"{ES_BARE} {ES_IC} logía logías ución uciones encia encias amente mente idad idades iva ivo ivas ivos"
        e = _longest(word, groups)
        if not e:
            return None
        rest, at = word[: len(word) - len(e)], len(word) - len(e)
        if e == "amente":
            if at < r1:
                return None
            if (shorter := _cut(rest, "iv", r2)) is not None:
                return _cut(shorter, "at", r2) or shorter
            return next((c for x in ("os", "ic", "ad") if (c := _cut(rest, x, r2)) is not None), rest)
        if at < r2:
            return None
        also: tuple[str, ...] = ()
        if e in _endings(ES_IC):
            also = ("ic",)
        elif e == "mente":
            also = ("ante", "able", "ible")
        elif e.startswith("idad"):
            also = ("abil", "ic", "iv")
        elif e in ("iva", "ivo", "ivas", "ivos"):
            also = ("at",)
        elif e.startswith("log"):
            return rest + "log"
        elif e in ("ución", "uciones"):
            return rest + "u"
        elif e.startswith("encia"):
            return rest + "ente"
        return next((c for x in also if (c := _cut(rest, x, r2)) is not None), rest)

    done = first()
    if done is not None:
        word = done
    elif (e := _longest(word, ES_Y, rv)) and word[: -len(e)].endswith("u"):
        word = word[: -len(e)]
    elif e := _longest(word, f"{ES_GU} {ES_VERBS}", rv):
        word = word[: -len(e)]
        if e in _endings(ES_GU) and word.endswith("gu"):
            word = word[:-1]
    if _longest(word, "os a o á í ó", rv):
        word = word[: -len(_longest(word, "os a o á í ó", rv))]
    elif _longest(word, "e é", rv):
        word = word[:-1]
        if word.endswith("gu") and len(word) - 1 >= rv:
            word = word[:-1]
    return word.translate(plain)


def french(word: str) -> str:
    v = VOWELS["fr"]
    marked = list(word)
    for k, c in enumerate(word):
        before, after = k > 0 and marked[k - 1] in v, k + 1 < len(word) and word[k + 1] in v
        if c in "ui" and before and after or c == "y" and (before or after) or c == "u" and k > 0 and word[k - 1] == "q":
            marked[k] = c.upper()
    word = "".join(marked)
    r1 = _region(word, v)
    r2 = _region(word, v, r1)
    if len(word) > 1 and word[0] in v and word[1] in v or word.startswith(("par", "col", "tap")):
        rv = min(3, len(word))
    else:
        rv = next((k + 1 for k in range(1, len(word)) if word[k] in v), len(word))
    start, again = word, True

    def first() -> tuple[str, bool]:
        """What the first step leaves, and whether verb endings are looked for all the same."""
        groups = f"{FR_BARE} {FR_IC} logie logies usion ution usions utions ence ences ement ements ité ités if ive ifs ives eaux aux euse euses issement issements amment emment ment ments"
        e = _longest(word, groups)
        rest, at = word[: len(word) - len(e)], len(word) - len(e)
        if not e:
            return word, True
        if e in _endings(FR_BARE):
            return (rest, False) if at >= r2 else (word, True)
        if e in _endings(FR_IC):
            if at < r2:
                return word, True
            if rest.endswith("ic"):
                return (rest[:-2] if at - 2 >= r2 else rest[:-2] + "iqU"), False
            return rest, False
        if e.startswith("logie") or e.startswith(("usion", "ution")) or e.startswith("ence"):
            return (rest + ("log" if e[0] == "l" else "u" if e[0] == "u" else "ent"), False) if at >= r2 else (word, True)
        if e in ("ement", "ements"):
            if at < rv:
                return word, True
            if rest.endswith("iv"):
                if at - 2 >= r2:
                    rest = rest[:-2]
                    rest = _cut(rest, "at", r2) or rest
            elif rest.endswith("eus"):
                rest = rest[:-3] if at - 3 >= r2 else rest[:-3] + "eux" if at - 3 >= r1 else rest
            elif rest.endswith(("abl", "iqU")):
                rest = rest[:-3] if at - 3 >= r2 else rest
            elif rest.endswith(("ièr", "Ièr")):
                rest = rest[:-3] + "i" if at - 3 >= rv else rest
            return rest, False
        if e in ("ité", "ités"):
            if at < r2:
                return word, True
            if rest.endswith("abil"):
                rest = rest[:-4] if at - 4 >= r2 else rest[:-4] + "abl"
            elif rest.endswith("ic"):
                rest = rest[:-2] if at - 2 >= r2 else rest[:-2] + "iqU"
            elif rest.endswith("iv"):
                rest = rest[:-2] if at - 2 >= r2 else rest
            return rest, False
        if e in ("if", "ive", "ifs", "ives"):
            if at < r2:
                return word, True
            if (shorter := _cut(rest, "at", r2)) is not None:
                rest = shorter
                if rest.endswith("ic"):
                    rest = rest[:-2] if len(rest) - 2 >= r2 else rest[:-2] + "iqU"
            return rest, False
        if e == "eaux":
            return rest + "eau", False
        if e == "aux":
            return (rest + "al", False) if at >= r1 else (word, True)
        if e in ("euse", "euses"):
            return (rest, False) if at >= r2 else (rest + "eux", False) if at >= r1 else (word, True)
        if e in ("issement", "issements"):
            return (rest, False) if at >= r1 and rest and rest[-1] not in v else (word, True)
        if e in ("amment", "emment"):
            return (rest + ("ant" if e[0] == "a" else "ent"), True) if at >= rv else (word, True)
        return (rest, True) if rest and rest[-1] in v and at - 1 >= rv else (word, True)

    word, again = first()
    if again:
        changed = False
        if (e := _longest(word, FR_I_VERBS, rv)) and len(word) - len(e) - 1 >= rv and word[-len(e) - 1] not in v:
            word, changed = word[: -len(e)], True
        if not changed:
            e = _longest(word, f"ions {FR_E_VERBS} {FR_A_VERBS}", rv)
            if e == "ions":
                word = word[:-4] if len(word) - 4 >= r2 else word
            elif e in _endings(FR_E_VERBS):
                word = word[: -len(e)]
            elif e:
                word = word[: -len(e)]
                if word.endswith("e") and len(word) - 1 >= rv:
                    word = word[:-1]
    if word != start:
        if word.endswith("Y"):
            word = word[:-1] + "i"
        elif word.endswith("ç"):
            word = word[:-1] + "c"
    else:
        if len(word) > 1 and word.endswith("s") and word[-2] not in "aiouès":
            word = word[:-1]
        e = _longest(word, "ion ier ière Ier Ière e", rv)
        if e == "ion":
            word = word[:-3] if len(word) - 3 >= r2 and len(word) - 4 >= rv and word[-4] in "st" else word
        elif e == "e":
            word = word[:-1]
        elif e:
            word = word[: -len(e)] + "i"
    if word.endswith(("enn", "onn", "ett", "ell", "eill")):
        word = word[:-1]
    k = len(word)
    while k and word[k - 1] not in v:
        k -= 1
    if 0 < k < len(word) and word[k - 1] in "éè":
        word = word[: k - 1] + "e" + word[k:]
    return word.lower()


STEMMERS: dict[str, Callable[[str], str]] = {"german": german, "spanish": spanish, "french": french}
