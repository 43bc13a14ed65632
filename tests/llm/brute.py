"""Plain Python versions of the conversation and repeat operators, for small inputs."""

import hashlib
import zlib
from collections import defaultdict

WS = " \t\n\x0b\f\r"


def repair(rows):
    """rows of (conv_id, turn, role, text) -> {conv_id: result tuple}, by shortest paths over row by row edits."""
    convs, out = defaultdict(list), {}
    for c, t, r, x in rows:
        convs[c]
        s = lambda v: " " if v is None else str(v)
        tag = zlib.crc32(f"{s(c)}:{s(t)}".encode()) % 20
        r, x = s(r), s(x)
        if tag == 0:
            continue
        if tag == 1:
            x = ""
        if tag == 2:
            x = "".join(ch for ch in x if ch not in ".!?")
        if tag == 4:
            r = "user"
        convs[c] += [(t, r, x)] * (2 if tag == 3 else 1)
    for c, rs in convs.items():
        md = lambda r, x: hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).digest()
        rs.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2][:64], md(v[1], v[2])))
        seen, faults = set(), []
        for _, r, x in rs:
            body = x.strip(WS)
            faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add((r, x))
        turns = {t for t, _, _ in rs if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        ini = [r[:1] for _, r, _ in rs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:]))
        step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
        # a state's best prefix is not enough for ties of later letters, so all (cost, audit) prefixes are kept per state
        layers = {q: {v} for q, v in ((0, (0, "", ())),)}

        def close(layers):
            for _ in range(3):
                for q in list(layers):
                    for cost, audit, lines in list(layers[q]):
                        for role in ("user", "assistant"):
                            if (q, role[0]) in step and not audit.endswith("II"):
                                layers.setdefault(step[q, role[0]], set()).add((cost + 2, audit + "I", (*lines, role + ":")))
            return {q: {v for v in vs if v[0] <= min(w[0] for w in vs)} for q, vs in layers.items()}

        layers = close(layers)
        for (_, r, x), f in zip(rs, faults):
            new = {}
            for q, vs in layers.items():
                for cost, audit, lines in vs:
                    new.setdefault(q, set()).add((cost + 3, audit + "D", lines))
                    if f in ("blank", "duplicate"):
                        continue
                    extra = f == "truncated"
                    if (q, r[:1]) in step:
                        new.setdefault(step[q, r[:1]], set()).add((cost + extra, audit + "K", (*lines, f"{r}:{x}")))
                    for role in ("user", "assistant"):
                        if (q, role[0]) in step:
                            new.setdefault(step[q, role[0]], set()).add((cost + 2 + extra, audit + "R", (*lines, f"{role}:{x}")))
            layers = close(new)
        cost, audit, lines = min(v for q in (0, 3) if q in layers for v in layers[q]) if rs else (0, "", ())
        text = "\n".join(lines)
        out[c] = (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def trie(rows):
    """rows of (conv_id, turn, role, text) -> sorted node rows of the rebuilt conversations."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t, r or "", x or ""))
    md = lambda r, x: hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).digest()
    for c, ts in own.items():
        ts.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2][:64], md(v[1], v[2])))
        own[c] = [v[1:] for v in ts]
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - c % 100, [])[:h]) + tuple(ts[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p)))).encode()).hexdigest()) for p, m in members.items()))


def cut(texts, window):
    """[(n_bytes, n_removed, n_spans, sha256 of the rest)] by a table of all windows."""
    bodies = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for b in bodies:
        for i in range(len(b) - window + 1):
            seen[b[i:i + window]] += 1
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        runs = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out
