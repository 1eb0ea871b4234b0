"""Distinct sampled segmentations of whole texts, and back to text.

The pieces of a sentencepiece model span a lattice over a text. Every path is a
segmentation; its probability is the product of its piece weights over the sum of all
paths, which backward sums give exactly. The operator draws the k paths with the largest
Gumbel-perturbed log probabilities, that is, k paths without replacement.

The search is A-star over sets of paths. The perturbed maximum of a set is an exact bound
for its members: the whole lattice has a Gumbel as its maximum; the best path of a set is
an ordinary draw from it and takes over the set's value; the rest splits by the first
place where a path leaves the drawn one, and each part gets a Gumbel with the part's mass
as its location, cut off at the value of the set. The queue hands out the part with the
largest value next. No piece crosses the start of a run of spaces or a line break, so the
lattice is a chain of small ones and a place is a chunk of text; lattices of chunks are
built once per task, many at a time.

All random numbers are hashes of the row's key, the sample, the chunk and the step:
partitions, batches and repeated tasks do not change them. The value of the first path
left out, kappa, gives each drawn path its inclusion score
``log(1 - exp(-exp(log_prob - kappa)))``; it is 0 when all paths were drawn.

Models with whole, falling scores (merge ranks) get weights ``1 / (1 + rank)``; other
scores are taken as log probabilities. ``ALPHA`` flattens both.

Defined cases: a null or empty text has one segmentation, the empty one; texts with fewer
than k segmentations give all of them; ties of values go to the earlier place; rows with
equal keys and texts get equal samples, rows without a key share one; an empty table
gives an empty result. A single chunk without spaces is worked on whole, however long.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import frugal, give_back, keep_between_tasks, key_type, record, slices
from factgraph.llm.token_counts import CHUNK, model_path

MODEL = "piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 0.5
# Chunks whose lattices a worker keeps; beyond, it starts anew.
REMEMBERED = 480_000
# Chunks whose lattices are built at once.
BUILT = 4096
SLICE = 1 << 19
# A path whose log probability is nearer to 0 than this has its rest summed up.
NEAR = 1e-6
SPACE = 0x2581
OWNER = "sampled_encoding"
# What a step along an edge reads stands together.
EDGE = np.dtype([("logp", np.float64), ("cum", np.float32), ("next", np.int32)])

U = np.uint64
BASE, MASK = 0x9E3779B97F4A7C15, 2**64 - 1
# Upper bits of a hash that choose a slot.
TABLE = 20


def mix(x):
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def uniform(x):
    """Numbers strictly between 0 and 1 from hashed counters."""
    return ((mix(x) >> U(12)).astype(np.float64) + 0.5) * 2.0**-52


def uniform_of(x: int) -> float:
    """``uniform`` of one number."""
    x &= MASK
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return ((x ^ (x >> 31)) // 4096 + 0.5) * 2.0**-52


class Vocabulary:
    """Pieces of one model: weights, and hashes of the pieces by length."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.bytes = np.full(256, -1, np.int32)
        self.unknown = model.unk_id()
        scores = np.array([model.get_score(i) for i in range(n)])
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.text = [b""] * n
        for i in range(n):
            if model.is_byte(i):
                self.bytes[int(names[i][3:-1], 16)] = i
                self.text[i] = bytes([int(names[i][3:-1], 16)])
            elif not model.is_control(i) and not model.is_unknown(i):
                self.text[i] = names[i].replace("▁", " ").encode()
        self.bytes_of = pa.array(self.text, pa.large_binary())
        ranks = scores[plain]
        if len(ranks) and (ranks <= 0).all() and (ranks == np.floor(ranks)).all():
            weights = -np.log1p(-ranks)
            self.weights = np.full(n, weights.min())
            self.weights[plain] = weights - np.logaddexp.reduce(weights)
            self.weights[self.weights > 0] = 0
        else:
            self.weights = scores.astype(float)
        lowest = self.weights[plain].min() if plain else -20.0
        rest = np.setdiff1d(np.arange(n), plain)
        self.weights[rest] = lowest
        self.weights = self.weights * alpha
        # Pieces and their beginnings by the upper bits of their hashes; where several pieces
        # meet in one slot, the slot says so and the sorted list decides.
        hashes, begins = {}, np.zeros(1 << TABLE, bool)
        self.longest = 1
        for i in plain:
            if "▁" in names[i].lstrip("▁") or "\n" in names[i]:
                raise ValueError("a piece crosses a cut; this model needs other cuts")
            h = 0
            for c in names[i]:
                h = (h + ord(c)) * BASE & MASK
                begins[h >> 64 - TABLE] = True
            hashes[h] = i
            self.longest = max(self.longest, len(names[i]))
        self.begins = begins
        self.hashes = np.array(sorted(hashes), U)
        self.ids = np.array([hashes[int(h)] for h in self.hashes], np.int32)
        self.slot = np.full(1 << TABLE, -1, np.int32)
        at = (self.hashes >> U(64 - TABLE)).astype(np.int64)
        self.slot[at] = np.arange(len(at))
        twice = np.unique(at[1:][at[1:] == at[:-1]])
        self.slot[twice] = -2

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``h`` that are pieces, and their ids."""
        at = self.slot[(h >> U(64 - TABLE)).astype(np.int64)]
        many = np.flatnonzero(at == -2)
        if len(many):
            k = np.searchsorted(self.hashes, h[many])
            k[k == len(self.hashes)] = 0
            at[many] = np.where(self.hashes[k] == h[many], k, -1)
        hit = np.flatnonzero(at >= 0)
        hit = hit[self.hashes[at[hit]] == h[hit]]
        return hit, self.ids[at[hit]]


class Lattices:
    """Lattices of chunks in flat arrays: nodes, and their edges from the likeliest on."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary, self.remembered = vocabulary, remembered
        self.start, self.degree = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int16)
        self.edge, self.piece = np.zeros(1 << 17, EDGE), np.zeros(1 << 17, np.int32)
        self._views()
        self.clear()

    def _views(self) -> None:
        self.logp, self.cum, self.next = (self.edge[name] for name in EDGE.names)

    def clear(self) -> None:
        """Forget all chunks; the arrays stay, to be filled again."""
        self.index: dict[str, int] = {}
        self.near: dict[int, float] = {}
        self.first = np.zeros(0, np.int64)  # by chunk
        self.nodes = self.edges = 0

    def _room(self, nodes: int, edges: int) -> None:
        for names, need in ((("start", "degree"), self.nodes + nodes), (("edge", "piece"), self.edges + edges)):
            for name in names:
                own = getattr(self, name)
                if need > len(own):  # in place: no second copy while it grows
                    own.resize(need + len(own) // 8, refcheck=False)
        self._views()

    def occurrences(self, chunks: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.index.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [chunks[i] for i in missing.tolist()]
            self.learn(new)
            found[missing] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
        return found

    def learn(self, chunks: list[str]) -> None:
        new = [c for c in dict.fromkeys(chunks) if c not in self.index]
        for at in range(0, len(new), BUILT):
            self._build(new[at : at + BUILT])

    def _build(self, chunks: list[str]) -> None:
        v = self.vocabulary
        text = "".join(chunks).replace(" ", "▁")
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        ends = np.cumsum(sizes)
        end_of = np.repeat(ends, sizes)  # by code point
        at = np.arange(len(cp))
        chunk_of = np.repeat(np.arange(len(chunks)), sizes)
        # Nodes: one before each code point and one at the end of each chunk.
        node_of = at + chunk_of
        src, width, pid = [at[:0]], [at[:0]], [np.zeros(0, np.int32)]
        live, h = at, np.zeros(len(cp), U)
        single = np.zeros(len(cp), bool)
        for size in range(1, v.longest + 1):
            fits = np.flatnonzero(live + size <= end_of[live])
            live, h = live[fits], h[fits]
            if not len(live):
                break
            h = (h + cp[live + (size - 1)]) * U(BASE)
            more = np.flatnonzero(v.begins[(h >> U(64 - TABLE)).astype(np.int64)])
            live, h = live[more], h[more]
            hit, ids = v.find(h)
            src.append(node_of[live[hit]]), width.append(np.full(len(hit), size)), pid.append(ids)
            if size == 1:
                single[live[hit]] = True
        n_nodes = len(cp) + len(chunks)
        src, width, pid = np.concatenate(src), np.concatenate(width), np.concatenate(pid)
        weight = v.weights[pid]
        # Code points without a piece go by their bytes, in extra nodes.
        odd = np.flatnonzero(~single)
        chains = []
        extra = []
        for p in odd.tolist():
            data = chr(int(cp[p])).encode("utf-8", "surrogatepass")
            ids = [int(v.bytes[b]) for b in data] if v.bytes[data[0]] >= 0 else [v.unknown]
            extra.append(sum(float(v.weights[i]) for i in ids))
            chains.append(ids)
        mark = np.full(len(src) + len(odd), -1)
        mark[len(src) :] = np.arange(len(odd))
        src, width = np.concatenate([src, node_of[odd]]), np.concatenate([width, np.ones(len(odd), np.int64)])
        weight, pid = np.concatenate([weight, np.array(extra)]), np.concatenate([pid, np.array([c[0] for c in chains], np.int32)])
        # Backward sums, from the ends of all chunks at once; long pieces first, which are
        # the likely ones.
        last = ends + np.arange(len(chunks))
        left = np.repeat(last, sizes + 1) - np.arange(n_nodes)  # code points from a node to its chunk's end
        beta = np.full(n_nodes, -np.inf)
        beta[last] = 0.0
        rank = (left[src] * n_nodes + src) * (v.longest + 1) + (v.longest - width)  # no two alike
        order = np.argsort(rank.astype(np.int32) if len(rank) and rank.max() < 1 << 31 else rank)
        src, width, pid, weight, mark = src[order], width[order], pid[order], weight[order], mark[order]
        dst, level = src + width, left[src]
        heads = np.flatnonzero(np.concatenate([[True], src[1:] != src[:-1]])) if len(src) else np.zeros(0, np.int64)
        cuts = np.searchsorted(level, np.unique(level)).tolist() + [len(level)]
        inside = np.searchsorted(heads, cuts).tolist()
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            own = heads[inside[i] : inside[i + 1]]
            beta[src[own]] = np.logaddexp.reduceat(weight[a:b] + beta[dst[a:b]], own - a)
        # On a grid of 2^-32, so that sums are exact and do not depend on what stands beside a text.
        logp = np.round(np.minimum(weight + beta[dst] - beta[src], 0.0) * 2.0**32) / 2.0**32
        # Bytes after the first of a chain: one node and one sure edge each.
        more_next, more_piece = [], []
        for e in np.flatnonzero(mark >= 0).tolist():
            ids = chains[mark[e]]
            if len(ids) > 1:
                goal = int(dst[e])
                dst[e] = n_nodes + len(more_next)
                for i, piece in enumerate(ids[1:]):
                    more_next.append(goal if i == len(ids) - 2 else n_nodes + len(more_next) + 1)
                    more_piece.append(piece)
        degree = np.bincount(src, minlength=n_nodes)
        start = np.zeros(n_nodes, np.int64)
        start[src[heads]] = heads
        total = np.concatenate([[0.0], np.cumsum(np.exp(logp))])
        cum = total[1:] - total[start[src]]
        cum[start[src[heads]] + degree[src[heads]] - 1] = 2.0
        k, nodes, edges = len(more_next), self.nodes, self.edges
        self._room(n_nodes + k, len(src) + k)
        self.index.update(zip(chunks, range(len(self.first), len(self.first) + len(chunks)), strict=True))
        self.first = np.concatenate([self.first, nodes + last - sizes])
        self.nodes, self.edges = nodes + n_nodes + k, edges + len(src) + k
        self.start[nodes : self.nodes] = edges + np.concatenate([start, len(src) + np.arange(k)])
        self.degree[nodes : self.nodes] = np.concatenate([degree, np.ones(k, np.int64)])
        for name, values, tail in (
            ("cum", cum, np.full(k, 2.0)),
            ("logp", logp, np.zeros(k)),
            ("next", nodes + dst, nodes + np.array(more_next, np.int64)),
            ("piece", pid, np.array(more_piece, np.int64)),
        ):
            getattr(self, name)[edges : self.edges] = np.concatenate([values, tail])

    def draw(self, chunk: np.ndarray, key: np.ndarray):
        """A path for every chunk: ``edges of each, log probability of each, whether it has
        others beside it, edges``."""
        count, logp, forked = np.zeros(len(chunk), np.int64), np.zeros(len(chunk)), np.zeros(len(chunk), bool)
        live, node, steps, step = np.arange(len(chunk)), self.first[chunk], [], 0
        total, others = np.zeros(len(chunk)), np.zeros(len(chunk), bool)  # of those not at their end
        while True:
            degree = self.degree[node]
            open_ = np.flatnonzero(degree)
            if len(open_) < len(node):
                ended = np.flatnonzero(degree == 0)
                at = live[ended]
                count[at], logp[at], forked[at] = step, total[ended], others[ended]
                live, node, key, degree, total, others = (x[open_] for x in (live, node, key, degree, total, others))
            if not len(live):
                break
            others |= degree > 1
            at = self.start[node].astype(np.int64)
            u = uniform(key + U(step * BASE & MASK))
            over = np.flatnonzero(u >= self.cum[at])
            while len(over):
                at[over] += 1
                over = over[u[over] >= self.cum[at[over]]]
            total += self.logp[at]
            steps.append((live, at))
            node = self.next[at]
            step += 1
        offset = np.cumsum(count) - count
        path = np.empty(int(count.sum()), np.int64)
        for step, (live, found) in enumerate(steps):
            path[offset[live] + step] = found
        return count, logp, forked, path

    def _steps(self, node: int, trie: dict, rest: dict[int, float]) -> list[float]:
        """Log masses of the edges of a node, without the paths of ``trie`` that go on there."""
        a, n = int(self.start[node]), int(self.degree[node])
        own = self.logp[a : a + n].tolist()
        return [x + rest[id(trie[a + i])] if a + i in trie else x for i, x in enumerate(own)]

    def _rests(self, chunk: int, excluded: list[list[int]]) -> tuple[dict, dict[int, float]]:
        """The excluded paths as a trie of edges, and the log mass that each of its nodes keeps
        without them. Sums of what stays, from the ends on; nothing is taken from 1."""
        root: dict = {}
        for path in excluded:
            at = root
            for e in path:
                at = at.setdefault(e, {})
        order = [(root, int(self.first[chunk]))]
        for trie, _ in order:
            order += [(below, int(self.next[e])) for e, below in trie.items()]
        rest: dict[int, float] = {}
        for trie, node in reversed(order):
            rest[id(trie)] = _logsum(self._steps(node, trie, rest)) if trie else -np.inf
        return root, rest

    def remaining(self, chunk: int, excluded: list[list[int]]) -> float:
        """Log probability that a path of a chunk is none of ``excluded``; -inf if there is no other."""
        root, rest = self._rests(chunk, excluded)
        return min(rest[id(root)], 0.0)

    def rests_near(self, chunk: np.ndarray, path_of) -> np.ndarray:
        """``remaining`` of chunks whose drawn path is all but sure. Such a chunk has no second
        path like it, so the answer is remembered by chunk; ``path_of`` gives the path at a place."""
        known = self.near
        for i in np.unique(chunk, return_index=True)[1].tolist():
            if int(chunk[i]) not in known:
                known[int(chunk[i])] = self.remaining(int(chunk[i]), [path_of(i)])
        return np.fromiter(map(known.__getitem__, chunk.tolist()), np.float64, len(chunk))

    def draw_other(self, chunk: int, excluded: list[list[int]], key: int):
        """A path of one chunk that is none of ``excluded``: ``edges, log probability``."""
        from math import exp

        trie, rest = self._rests(chunk, excluded)
        if rest[id(trie)] == -np.inf:
            return None
        node, path, total, step = int(self.first[chunk]), [], 0.0, 0
        while int(self.degree[node]):
            a = int(self.start[node])
            steps = self._steps(node, trie, rest)
            top = max(steps)
            mass = [exp(x - top) for x in steps]
            u = uniform_of(key + (step + 1) * BASE) * sum(mass)
            i = 0
            while i < len(mass) - 1 and u >= mass[i]:
                u -= mass[i]
                i += 1
            while steps[i] == -np.inf:
                i -= 1
            path.append(a + i)
            total += float(self.logp[a + i])
            trie, node = trie.get(a + i, {}), int(self.next[a + i])
            step += 1
        return path, total


def _logsum(values: list[float]) -> float:
    from math import exp, log

    top = max(values)
    return top if top == -np.inf else top + log(sum(exp(x - top) for x in values))


class Sampler:
    def __init__(self, path: str, samples: int = SAMPLES, alpha: float = ALPHA, seed: int = 0, remembered: int = REMEMBERED):
        self.lattices = Lattices(Vocabulary(path, alpha), remembered)
        self.samples, self.seed = samples, seed

    def chunks(self, text: str | None) -> list[str]:
        return CHUNK.findall(" " + text.replace("▁", " ")) if text else []

    def sample(self, keys: list, texts: list[str | None]) -> list[list[tuple]]:
        """Per text up to ``samples`` tuples ``log_prob, value, log_inclusion, pieces``."""
        import xxhash

        k, lattices = self.samples, self.lattices
        if len(lattices.index) > lattices.remembered:
            lattices.clear()
        parts = [self.chunks(t) for t in texts]
        sizes = np.array([len(p) for p in parts])
        chunk = lattices.occurrences([c for p in parts for c in p])
        lo = np.cumsum(sizes) - sizes
        hi = lo + sizes
        row = np.array([xxhash.xxh3_64_intdigest(str(x), self.seed) for x in keys], U)
        place = np.arange(len(chunk)) - np.repeat(lo, sizes)
        key = mix(np.repeat(row, sizes) + place.astype(U) * U(0xD6E8FEB86659FD93))
        out: list[list[tuple]] = [[] for _ in texts]
        queues: list[list] = [[] for _ in texts]
        paths: list[list] = [[] for _ in texts]
        root = -np.log(-np.log(uniform(row + U(0xA5A5A5A5))))
        # What each text draws next: value, place, base sample, excluded paths there.
        turn = [(float(g), -1, -1, []) for g in root]
        for r in range(k):
            # A path that leaves another at a place is that path before it, so only what stands
            # behind is drawn; a text without further paths draws nothing.
            leaves = [now[1] if now else n for now, n in zip(turn, sizes.tolist(), strict=True)]
            at = np.flatnonzero(place > np.repeat(np.array(leaves, np.int64), sizes))
            count, logp, forked = np.zeros(len(chunk), np.int64), np.zeros(len(chunk)), np.zeros(len(chunk), bool)
            count[at], logp[at], forked[at], edges = lattices.draw(chunk[at], key[at] + U(r * 0xC2B2AE3D27D4EB4F & MASK))
            tail = np.cumsum(count) - count
            value = np.empty(len(texts))
            for d, now in enumerate(turn):
                value[d] = now[0] if now else -np.inf
                if now is None:
                    continue
                a, b, c, base = int(lo[d]), int(hi[d]), now[1], now[2]
                own_logp, own_count = logp[a:b], count[a:b]
                first, last = (int(tail[a]), int(tail[b - 1] + count[b - 1])) if b > a else (0, 0)
                own = edges[first:last]
                if c >= 0:
                    then = paths[d][base]
                    here = lattices.draw_other(int(chunk[a + c]), now[3], int(row[d]) ^ (r * 0x9E3779B9 + c))
                    if here is None:
                        turn[d] = None
                        value[d] = -np.inf
                        continue
                    before = int(then[1][:c].sum())
                    after = int(tail[a + c] + count[a + c]) - first
                    own = np.concatenate([then[2][:before], np.array(here[0], np.int64), own[after:]])
                    own_logp = np.concatenate([then[0][:c], [here[1]], own_logp[c + 1 :]])
                    own_count = np.concatenate([then[1][:c], [len(here[0])], own_count[c + 1 :]])
                    logp[a:b] = own_logp
                    forked[a + c] = False  # what is left there is summed up below
                paths[d].append((own_logp, own_count, own))
            # Masses of the parts that leave the new paths at each place, and their values.
            ahead = np.cumsum(logp)
            ahead = ahead - logp - np.repeat(np.where(sizes > 0, (ahead - logp)[np.minimum(lo, max(len(logp) - 1, 0))] if len(logp) else 0.0, 0.0), sizes)
            bound = np.full(len(chunk), -np.inf)
            with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
                mass = ahead[at] + np.log(-np.expm1(np.minimum(logp[at], 0.0)))
                # So near 1 the rest cannot be taken from it; it is summed up instead.
                near = np.flatnonzero(forked[at] & (logp[at] > -NEAR))
                if len(near):
                    there = at[near]
                    mass[near] = ahead[there] + lattices.rests_near(chunk[there], lambda i, there=there: edges[tail[there[i]] : tail[there[i]] + count[there[i]]].tolist())
                cap = np.repeat(value, sizes)[at]
                noise = uniform(key[at] + U((r + 1) * 0x165667B19E3779F9 & MASK))
                free = mass - np.log(np.exp(np.minimum(mass - cap, 700.0)) - np.log(noise))
            bound[at] = np.where(forked[at] & np.isfinite(mass), free, -np.inf)
            for d, now in enumerate(turn):
                if now is None:
                    continue
                a, b, c = int(lo[d]), int(hi[d]), now[1]
                own = paths[d][-1]
                own_bound = bound[a:b]
                if c >= 0:
                    own_bound[:c] = -np.inf
                    drawn = self._path(own, c)
                    excluded = [*now[3], drawn]
                    m = float(ahead[a + c]) + lattices.remaining(int(chunk[a + c]), excluded)
                    u = uniform_of(int(row[d]) + (r + 7) * 0xD6E8FEB86659FD93)
                    own_bound[c] = _cut_off(m, now[0], u)
                most = k - r
                best = np.argpartition(-own_bound, most - 1)[:most] if len(own_bound) > most else np.arange(len(own_bound))
                for i in best.tolist():
                    if own_bound[i] > -np.inf:
                        gone = excluded if i == c else [self._path(own, i)]
                        heapq.heappush(queues[d], (-float(own_bound[i]), i, len(paths[d]) - 1, gone))
                out[d].append((float(own[0].sum()), now[0], lattices.piece[own[2]]))
                turn[d] = None
                if queues[d]:
                    g, i, base, gone = heapq.heappop(queues[d])
                    turn[d] = (-g, i, base, gone)
        done = []
        for found, now in zip(out, turn, strict=True):
            kappa = now[0] if now else -np.inf
            done.append([(lp, g, _inclusion(lp, kappa), p) for lp, g, p in found])
        return done

    @staticmethod
    def _path(own: tuple, c: int) -> list[int]:
        at = int(own[1][:c].sum())
        return own[2][at : at + int(own[1][c])].tolist()


@lru_cache(maxsize=1)
def sampler_of(path: str, samples: int, alpha: float, seed: int, remembered: int = REMEMBERED) -> Sampler:
    """One per Python worker, which Spark keeps for later tasks, with the lattices it holds
    until the worker serves another operator."""
    keep_between_tasks(OWNER, sampler_of.cache_clear)
    sampler = Sampler(path, samples, alpha, seed, remembered)
    give_back()  # of the model, only its pieces stay
    return sampler


def _cut_off(mass: float, cap: float, u: float) -> float:
    """A Gumbel at ``mass`` that stays below ``cap``, as a function of a uniform number."""
    if mass == -np.inf:
        return -np.inf
    return mass - float(np.log(np.exp(min(mass - cap, 700.0)) - np.log(u)))


def _inclusion(logp: float, kappa: float) -> float:
    if kappa == -np.inf:
        return 0.0
    x = logp - kappa
    return float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else float(x)


def decode(text_of: list[bytes] | pa.LargeBinaryArray, pieces) -> str:
    if isinstance(text_of, pa.LargeBinaryArray):
        data = (text_of.take(pa.array(pieces)).buffers()[2] if len(pieces) else None) or b""
        data = data if isinstance(data, bytes) else data.to_pybytes()
    else:
        data = b"".join(map(text_of.__getitem__, pieces.tolist() if hasattr(pieces, "tolist") else pieces))
    return data[1:].decode("utf-8", "replace") if data[:1] == b" " else data.decode("utf-8", "replace")


def segmentations(
    docs: DataFrame, samples: int = SAMPLES, path: str | None = None, alpha: float = ALPHA, seed: int = 0, with_ids: bool = True,
    remembered: int = REMEMBERED, limit: int = SLICE,
) -> DataFrame:
    """``doc_id, sample, n_pieces, log_prob, perturbed, log_inclusion, ids_crc32, decoded_crc32,
    decodes`` and, unless told not to, ``ids``: up to ``samples`` rows per whole text.

    Every segmentation is decoded where it was drawn: ``decoded_crc32`` is of the UTF-8 bytes
    of the decoded text, ``decodes`` says whether that is the text, a null one as an empty one
    and ▁ as a space, which it is to the model.

    ``remembered`` (chunks) and ``limit`` (bytes of text worked on at once) trade memory of a
    worker for time; the rows do not depend on them.
    """
    path = path or model_path(MODEL)
    kind = key_type(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        sampler = sampler_of(path, samples, alpha, seed, remembered)
        for whole in batches:
            for batch in slices(whole, limit=limit):
                texts = batch.column("text").to_pylist()
                found = sampler.sample(batch.column("doc_id").to_pylist(), texts)
                rows = [(i, s, *f) for i, own in enumerate(found) for s, f in enumerate(own)]
                sums, equal = [], []
                for r in rows:
                    back = decode(sampler.lattices.vocabulary.bytes_of, r[5])
                    sums.append(crc32(back.encode("utf-8", "surrogatepass")))
                    equal.append(back == (texts[r[0]] or "").replace("▁", " "))
                columns = {
                    "doc_id": batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                    "sample": pa.array([r[1] for r in rows], pa.int32()),
                    "n_pieces": pa.array([len(r[5]) for r in rows], pa.int64()),
                    "log_prob": pa.array([r[2] for r in rows], pa.float64()),
                    "perturbed": pa.array([r[3] for r in rows], pa.float64()),
                    "log_inclusion": pa.array([r[4] for r in rows], pa.float64()),
                    "ids_crc32": pa.array([crc32(r[5].astype("<u4").tobytes()) for r in rows], pa.int64()),
                    "decoded_crc32": pa.array(sums, pa.int64()),
                    "decodes": pa.array(equal, pa.bool_()),
                }
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum([len(r[5]) for r in rows])]).astype(np.int32)
                    flat = np.concatenate([r[5] for r in rows]) if rows else np.zeros(0, np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                if rows:
                    yield record(**columns)

    schema = f"doc_id {kind}, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids_crc32 long"
    schema += ", decoded_crc32 long, decodes boolean"
    return docs.select("doc_id", "text").mapInArrow(frugal(run, OWNER), schema + (", ids array<int>" if with_ids else ""))


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the text of the pieces; null ids give null."""
    path = path or model_path(MODEL)
    schema = rows.withColumn("decoded", F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = Vocabulary(path).text
        for batch in batches:
            texts = [None if x is None else decode(text_of, x) for x in batch.column(ids).to_pylist()]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return rows.mapInArrow(run, schema)
