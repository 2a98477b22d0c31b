"""Plain versions of the operators, over lists of rows, for small tables."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow.dataset as ds
import xxhash

SMALL = "/root/testdata/sf0.001"


def table(name, sf_dir=SMALL):
    return ds.dataset(f"{sf_dir}/{name}.parquet").to_table().to_pylist()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def groups(n, linked):
    """Smallest member reachable, for members 0..n-1 and a test of two members."""
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows(docs):
    docs = sorted(docs, key=lambda r: r["doc_id"])
    fps = [simhash(r["text"]) for r in docs]
    arr = np.array(fps, np.uint64)
    near = np.bitwise_count(arr[:, None] ^ arr[None, :]) <= 4
    root = groups(len(docs), lambda i, j: near[i, j])
    return [(r["doc_id"], f"{f:016x}", docs[g]["doc_id"]) for r, f, g in zip(docs, fps, root)]


def contamination_rows(docs, items, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = []
    for item in items:
        words = pattern.findall(lower(item["text"]))
        if words:
            windows += [(words[i : i + window], item["item_id"]) for i in range(max(1, len(words) - window + 1))]
    out = []
    for r in docs:
        words = pattern.findall(lower(r["text"]))
        hit, found = set(), set()
        first = {}
        for i, w in enumerate(words):
            first.setdefault(w, []).append(i)
        for w, item in windows:
            for i in first.get(w[0], []):
                if words[i : i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(str(item))
        digest = sha(",".join(sorted(found)))
        out.append((r["doc_id"], len(words), len(hit), len(found), digest, bool(hit)))
    return out


def line_rows(docs):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for r in docs:
        for line in (r["text"] or "").split("\n"):
            holders.setdefault(key(line), set()).add(r["doc_id"])
    keeper = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    out = []
    for r in docs:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), r["doc_id"]) == r["doc_id"]]
        out.append((r["doc_id"], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
