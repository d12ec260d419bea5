"""Plain single-process versions of the operators, for comparison on small tables."""

import hashlib
import itertools
import re
import zlib

BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words(text):
    return WORD.findall(text or "")


def kept_lines(rows, min_chars=20, min_docs=3):
    """rows: (id, text) -> per row (n_lines, n_dropped, text)."""

    def key(line):
        return ascii_lower(line.strip(BLANKS))

    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders[key(line)]
            last = max(ids, key=lambda x: (x is not None, x if x is not None else 0))
            if len(key(line)) < min_chars or len(ids) < min_docs or i == last:
                kept.append(line)
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text, size=5):
    w = words(ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def components(n, linked):
    """Labels 0..n-1 by the smallest index reachable over linked(i, j)."""
    label = list(range(n))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def jaccard_components(rows, num=80, den=100):
    """rows: (id, text) -> per row (id, n_shingles, component id)."""
    sets = [shingles(t) for _, t in rows]

    def linked(i, j):
        a, b = sets[i], sets[j]
        return bool(a and b) and den * len(a & b) >= num * len(a | b)

    label = components(len(rows), linked)
    least = {}
    for (i, _), at in zip(rows, label, strict=True):
        if i is not None:
            least[at] = min(least.get(at, i), i)
    return [(i, len(s), least.get(at) if s else i) for (i, _), s, at in zip(rows, sets, label, strict=True)]


def fill(budget, children):
    """Share a budget among children (weight, capacity) without exceeding a capacity."""
    given = [0.0] * len(children)
    open_ = [i for i, (w, _) in enumerate(children) if w > 0]
    while open_:
        rest = budget - sum(given)
        total = sum(children[i][0] for i in open_)
        full = [i for i in open_ if rest * children[i][0] / total >= children[i][1] - 1e-9]
        if not full:
            for i in open_:
                given[i] = rest * children[i][0] / total
            break
        # Those with the smallest capacity for their weight fill up first.
        first = min(full, key=lambda i: children[i][1] / children[i][0])
        given[first] = float(children[first][1])
        open_.remove(first)
        # Shares of the others are computed anew from what is left.
    return given


def mixed(rows, weights, share, max_epochs, seed=0):
    """rows: (id, text, level values...) with unique ids -> sorted (id, epoch)."""
    leaves = {}
    for r in rows:
        leaves.setdefault(tuple(r[2:]), []).append((r[0], len(words(r[1]))))
    total = {k: sum(t for _, t in v) for k, v in leaves.items()}
    budgets = {}

    def down(prefix, keys, budget):
        depth = len(prefix)
        if keys and depth == len(keys[0]):
            budgets[keys[0]] = budget
            return
        values = sorted({k[depth] for k in keys}, key=lambda v: (v is not None, v or ""))
        below = [[k for k in keys if k[depth] == v] for v in values]
        children = [
            (weights[depth].get(v, 1.0), max_epochs * sum(total[k] for k in b)) for v, b in zip(values, below, strict=True)
        ]
        for v, b, g in zip(values, below, fill(budget, children), strict=True):
            down((*prefix, v), b, g)

    if leaves:
        down((), sorted(leaves, key=str), float(int(sum(total.values()) * share)))
    out = []
    for k, docs in leaves.items():
        budget = min(int(budgets[k] + 1 / 16), max_epochs * total[k])
        full = budget // total[k] if total[k] else 0
        rest = budget - full * total[k]
        out += [(i, e) for i, _ in docs for e in range(full)]
        if full < max_epochs:

            def place(doc, full=full):
                name = hashlib.md5(str(doc[0]).encode()).hexdigest()
                return hashlib.md5(f"{seed}|{full}|{name}".encode()).hexdigest()

            used = 0
            for doc in sorted(docs, key=place):
                used += doc[1]
                if used > rest:
                    break
                out.append((doc[0], full))
    return sorted(out)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32(text.encode())


def merkle(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)."""

    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def up(level):
        """All levels from the given nodes to the one that is left."""
        levels = [level]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
        return levels

    def path(levels, at):
        out = []
        for level in levels[:-1]:
            pair = at - at % 2
            out.append((at % 2, [d for i, d in enumerate(level[pair : pair + 2], pair) if i != at]))
            at //= 2
        return out

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r, sha("".join(map(enc, r)))))
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    for members in trees.values():
        members.sort(key=lambda m: (m[0][0] is not None, m[0][0] or 0, m[1]))
    levels = {lang: up([leaf for _, leaf in trees[lang]]) for lang in langs}
    above = up([levels[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for at, (r, leaf) in enumerate(trees[lang]):
            steps = path(levels[lang], at) + path(above, k)
            now = leaf
            if r[0] is not None and crc(str(r[0])) % 7 == 0 and r[3] is not None:
                now = sha("".join(map(enc, (*r[:3], r[3] + 1, r[4]))))
            for side, others in steps:
                now = sha("".join([*others, now] if side else [now, *others]))
            root = above[-1][0]
            out.append((r[0], leaf, levels[lang][-1][0], root, sha("".join(d for _, o in steps for d in o)), now, now == root))
    return out


def damage(rows):
    """rows: (conv_id, turn, role, text) -> those left after damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def scripts(kinds, inserts=2):
    """Every edit of rows (initial, must go, truncated) with up to ``inserts`` turns at each place that gives a legal order: (cost, audit)."""
    legal = re.compile(r"(s?(ua)+)?")
    out = []

    def walk(i, cost, audit, roles):
        for n in range(inserts + 1):
            for new in itertools.product("ua", repeat=n):
                c, a, r = cost + 2 * n, audit + "I" * n, roles + "".join(new)
                if i == len(kinds):
                    if legal.fullmatch(r):
                        out.append((c, a))
                    continue
                initial, gone, cut = kinds[i]
                walk(i + 1, c + 3, a + "D", r)
                if not gone:
                    walk(i + 1, c + cut, a + "K", r + initial)
                    for role in "ua":
                        walk(i + 1, c + 2 + cut, a + "R", r + role)

    walk(0, 0, "", "")
    return out


def least_edits(kinds):
    """The least (cost, audit) of a conversation, by the least of every (rows done, last role)."""
    after = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    now = {"": (0, "")}

    def insert(ways):
        for _ in range(3):
            for last, (c, a) in list(ways.items()):
                for role in "ua":
                    if (last, role) in after:
                        ways[role] = min(ways.get(role, (c + 2, a + "I")), (c + 2, a + "I"))
        return ways

    for initial, gone, cut in kinds:
        then = {}
        for last, (c, a) in insert(now).items():
            options = [(last, c + 3, a + "D")]
            if not gone:
                if (last, initial) in after:
                    options.append((initial, c + cut, a + "K"))
                options += [(role, c + 2 + cut, a + "R") for role in "ua" if (last, role) in after]
            for role, cost, audit in options:
                then[role] = min(then.get(role, (cost, audit)), (cost, audit))
        now = then
    now = insert(now)
    return min(now[q] for q in ("", "a") if q in now)


def conversation_report(rows):
    """rows: (conv_id, turn, role, text) after damage, one conversation -> gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(BLANKS)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    kinds = [(r[2][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults, strict=True)]
    cost, audit = least_edits(kinds)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:], strict=False))
    lines, at = [], 0
    for edit in audit:
        forced = "assistant" if lines and lines[-1][0][:1] == "u" else "user"
        if edit == "I":
            lines.append((forced, ""))
            continue
        if edit != "D":
            lines.append((rows[at][2] if edit == "K" else forced, rows[at][3]))
        at += 1
    digest = sha("\n".join(f"{r}:{t}" for r, t in lines))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), lines
