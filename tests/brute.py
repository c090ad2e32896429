"""Plain-Python versions of the operators for small fixtures."""

from __future__ import annotations


def attribute_values(field):
    """[(pos, key, val)] and whether the quoting is whole: character by character."""
    if field is None:
        return [], True
    out, ok, key, pos, i, n = [], True, None, 0, 0, len(field)
    while i <= n:
        # one piece from i
        j = i
        while j < n and field[j] in " \t":
            j += 1
        word, value, quoted, junk = "", None, False, False
        if j < n and field[j] not in "\"'":
            k = j
            while k < n and field[k] not in ";,| \t=":
                k += 1
            word, j = field[j:k], k
            while j < n and field[j] in " \t":
                j += 1
            if j < n and field[j] == "=":
                value, j = "", j + 1
                while j < n and field[j] in " \t":
                    j += 1
            elif j < n and field[j] not in ";,|":
                value = ""
        else:
            value = ""
        if value is not None and j < n and field[j] in "\"'":
            q, quoted, j, buf, closed = field[j], True, j + 1, "", False
            while j < n:
                if field[j] == "\\" and field[j + 1 : j + 2] == q:
                    buf, j = buf + q, j + 2
                elif field[j] == q and field[j + 1 : j + 2] == q:
                    buf, j = buf + q, j + 2
                elif field[j] == q:
                    closed, j = True, j + 1
                    break
                else:
                    buf, j = buf + field[j], j + 1
            value = buf
            k = j
            while j < n and field[j] not in ";,|":
                j += 1
            junk = bool(field[k:j].strip(" \t"))
            ok = ok and closed and not junk
        elif value is not None:
            k = j
            while j < n and field[j] not in ";,|":
                j += 1
            value = field[k:j].strip(" \t")
        if value is None:
            value = word
        elif word:
            key = word
        if value and key is not None:
            pos += 1
            out.append((pos, key, value))
        while j < n and field[j] not in ";,|":
            j += 1
        i = j + 1
    return out, ok


def hierarchy(parent):
    """{node: (root, depth, n_desc)} from {node: parent or None}."""
    kids = {}
    for n, p in parent.items():
        if p is not None and p in parent:
            kids.setdefault(p, []).append(n)
    out = {}
    for n in parent:
        seen, stack = set(), list(kids.get(n, []))
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                stack += kids.get(x, [])
        seen.discard(n)
        up, d, at = {n}, 0, n
        while True:
            p = parent[at]
            if p is None or p not in parent:
                out[n] = (at, d, len(seen))
                break
            if p in up:
                out[n] = (-1, -1, len(seen))
                break
            up.add(p)
            at, d = p, d + 1
    return out
