"""Plain-Python Porter2, written from the published description, as a second opinion on the column version."""

V = set("aeiouy")


def _regions(w):
    def after(start):
        i = start
        while i < len(w) and w[i] not in V:
            i += 1
        while i < len(w) and w[i] in V:
            i += 1
        return i + 1 if i < len(w) else len(w)

    p1 = None
    for prefix in ("gener", "commun", "arsen"):
        if w.startswith(prefix):
            p1 = len(prefix)
    if p1 is None:
        p1 = after(0)
    return p1, after(p1)


def _short_end(w):
    if len(w) == 2:
        return w[0] in V and w[1] not in V
    return len(w) >= 3 and w[-3] not in V and w[-2] in V and w[-1] not in V and w[-1] not in "wxY"


def _any_vowel(w):
    return any(c in V for c in w)


def stem(word):
    whole = dict(skis="ski", skies="sky", dying="die", lying="lie", tying="tie", idly="idl", gently="gentl",
                 ugly="ugli", early="earli", only="onli", singly="singl")
    if word in whole:
        return whole[word]
    if word in "sky news howe atlas cosmos bias andes".split() or len(word) < 3:
        return word

    w = list(word)
    if w[0] == "y":
        w[0] = "Y"
    for i in range(1, len(w)):
        if w[i] == "y" and w[i - 1] in V:
            w[i] = "Y"
    w = "".join(w)
    p1, p2 = _regions(w)

    # 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-3] + ("i" if len(w) > 4 else "ie")
    elif w.endswith(("us", "ss")):
        pass
    elif w.endswith("s") and _any_vowel(w[:-2]):
        w = w[:-1]
    if w in "inning outing canning herring earring proceed exceed succeed".split():
        return w

    # 1b
    for s in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(s):
            base = w[: -len(s)]
            if s in ("eed", "eedly"):
                if len(base) >= p1:
                    w = base + "ee"
            elif _any_vowel(base):
                w = base
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif w[-2:] in ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"):
                    w = w[:-1]
                elif len(w) == p1 and _short_end(w):
                    w += "e"
            break

    # 1c
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in V:
        w = w[:-1] + "i"

    def replace(w, rules):
        for s in sorted(rules.split(), key=lambda r: -len(r.split(">")[0])):
            suffix, new = s.split(">")
            if w.endswith(suffix):
                return suffix, w[: -len(suffix)], new
        return None

    # 2
    hit = replace(w, "tional>tion enci>ence anci>ance abli>able entli>ent izer>ize ization>ize ational>ate ation>ate "
                     "ator>ate alism>al aliti>al alli>al fulness>ful ousli>ous ousness>ous iveness>ive iviti>ive "
                     "biliti>ble bli>ble ogi>og fulli>ful lessli>less li>")
    if hit:
        s, base, new = hit
        if len(base) >= p1:
            if s == "ogi":
                ok = base.endswith("l")
            elif s == "li":
                ok = base[-1:] in tuple("cdeghkmnrt")
            else:
                ok = True
            if ok:
                w = base + new
    # 3
    hit = replace(w, "tional>tion ational>ate alize>al icate>ic iciti>ic ical>ic ful> ness> ative>")
    if hit:
        s, base, new = hit
        if len(base) >= p1 and (s != "ative" or len(base) >= p2):
            w = base + new
    # 4
    hit = replace(w, "al> ance> ence> er> ic> able> ible> ant> ement> ment> ent> ism> ate> iti> ous> ive> ize> ion>")
    if hit:
        s, base, new = hit
        if len(base) >= p2 and (s != "ion" or base[-1:] in ("s", "t")):
            w = base
    # 5
    if w.endswith("e"):
        base = w[:-1]
        if len(base) >= p2 or (len(base) >= p1 and not _short_end(base)):
            w = base
    elif w.endswith("ll") and len(w) - 1 >= p2:
        w = w[:-1]
    return w.replace("Y", "y")
