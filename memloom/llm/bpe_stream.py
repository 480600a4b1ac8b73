"""BPE as a streaming transducer with bounded lookahead, and incremental decoding.

For a merge list in which each token is the product of one merge, and parts of
a merge come before it, appended text changes the tokens near the end only.  How
near follows from the list.  Merges apply in the order of their rank.  Say two
texts share a beginning, and all tokens before place D agree after the merges
so far.  The next merge (u, v) can move D to the left only if the last token
before D is u and v starts at D in one text; D then moves by the length of u,
and whatever starts there later begins with u.  So a chain of moves is a chain
of merges of rising rank in which each v begins with the u before it, and the
greatest total length of the u in such a chain is a sufficient lookahead:
tokens that end that far before the end of what has been read are final.

The transducer holds a window of that many symbols and some more, whatever the
length of the text.  Words repeat, so tasks keep the tokens that it gave for
short words in a dictionary of bounded size.  Texts come in parts, cut where no
word goes on if there is such a place; a word without an end goes to its
transducer part by part.  The decoder takes each part's tokens as they come.

Normalisation and the split into pieces are the tokenizer file's own, so that
every character has the library's letter class; only ASCII takes a short way.

Defined cases: a null text has no tokens and decodes to the empty text; every
row gives one row, whatever its id; an empty table gives none; other columns
stay, those named ids or decoded are replaced; a very long text takes memory
for its result only.
"""

from __future__ import annotations

import codecs
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from memloom.llm.common import worker_held

NONE = 1 << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is a visible Latin-1 sign, else the next free one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in visible else next(free)) for b in range(256)]


class MergeList:
    """Vocabulary and merges of a tokenizer file, with the lookahead that the merges need."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer[0]
        signs = "".join(map(chr, range(33, 127)))
        if self.normalizer.normalize_str(signs) != signs.lower():
            raise ValueError("ASCII isn't lower-cased")
        self.token = {i: t for t, i in (self.vocab | self.special).items()}
        self.joined = spec.get("decoder") is None
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {self.vocab[a] << 20 | self.vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.product = [self.vocab[a + b] for a, b in pairs]
        self.width = {i: len(t.removesuffix(self.suffix) if self.suffix else t) for t, i in self.vocab.items()}
        self.check(pairs)
        self.lookahead = self.sufficient_lookahead(pairs)
        signs = byte_symbols()
        self.first = [self.vocab[s] for s in signs]
        self.last = [self.vocab[s + self.suffix] for s in signs]

    def normal(self, text: str) -> str:
        return text.lower() if text.isascii() else self.normalizer.normalize_str(text)

    def spans(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        """Pieces of a normalised text, with their places."""
        return self.splitter.pre_tokenize_str(text)

    def check(self, pairs: list[tuple[str, str]]) -> None:
        """Raises unless parts come before their merges and no two merges have one product."""
        made: set[str] = set()
        for a, b in pairs:
            for part in (a, b):
                if len(part.removesuffix(self.suffix) if self.suffix else part) > 1 and part not in made:
                    raise ValueError(f"merge of {a!r} and {b!r} comes before its part {part!r}")
            if a + b in made:
                raise ValueError(f"two merges make {a + b!r}")
            made.add(a + b)

    def sufficient_lookahead(self, pairs: list[tuple[str, str]]) -> int:
        reach: dict[str, int] = {}
        for u, v in pairs:
            body = v.removesuffix(self.suffix) if self.suffix else v
            longest = len(u) + max((reach.get(v[:k], 0) for k in range(1, len(body) + (body == v))), default=0)
            reach[u] = max(reach.get(u, 0), longest)
        return max(reach.values(), default=1)

    def merged(self, ids: list[int]) -> list[int]:
        """Applies the merges to symbols, lowest rank first and then from the left."""
        if len(ids) > 48:
            return self._merged_long(ids)
        rank, product = self.rank, self.product
        ids = ids[:]
        ranks = [rank.get(a << 20 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            at = ranks.index(least)
            ids[at] = product[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank.get(ids[at - 1] << 20 | ids[at], NONE)
            if at < len(ranks):
                ranks[at] = rank.get(ids[at] << 20 | ids[at + 1], NONE)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for long windows."""
        n, rank = len(ids), self.rank
        ids, after, before, alive = ids[:], [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = self.product[r], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (r := rank.get(ids[k] << 20 | ids[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
        return [x for x, live in zip(ids, alive) if live]


class PieceTransducer:
    """Tokens of one piece whose bytes come in parts; memory is bounded by the lookahead."""

    def __init__(self, merges: MergeList):
        self.merges, self.window, self.held = merges, [], b""
        self.most = 4 * merges.lookahead + 256
        #: The last characters that came, a whole contraction if it is one: they tell whether the piece goes on.
        self.tail = ""

    def feed(self, data: bytes) -> list[int]:
        """Tokens that are final now.  The last byte waits, since the piece may end with it."""
        data = self.held + data
        self.held, out, first = data[-1:], [], self.merges.first
        for at in range(0, len(data) - 1, self.most):
            self.window += [first[b] for b in data[at : min(at + self.most, len(data) - 1)]]
            if len(self.window) >= self.most:
                out += self._settle()
        return out

    def _settle(self) -> list[int]:
        final, done, width = len(self.window) - self.merges.lookahead, 0, self.merges.width
        out = []
        for token in self.merges.merged(self.window):
            if done + width[token] > final:
                break
            out.append(token)
            done += width[token]
        self.window = self.window[done:]
        return out

    def finish(self) -> list[int]:
        out = self.merges.merged([*self.window, self.merges.last[self.held[0]]]) if self.held else []
        self.window, self.held = [], b""
        return out


class StreamingEncoder:
    """Text in parts of any size to token ids, in memory that no length of text, word or line changes."""

    #: Longest word whose tokens are kept, words and pieces that are kept (the first ones met), signs handled at once.
    WORD, KEPT, PART = 48, 100_000, 1 << 16

    def __init__(self, merges: MergeList, specials: bool = True):
        self.merges, self.words, self.pieces = merges, {}, {}
        self.names = sorted(merges.special, key=len, reverse=True) if specials else []
        self.named = regex.compile("|".join(map(regex.escape, self.names))) if self.names else None
        self.longest = max(map(len, self.names), default=0)

    def piece(self, piece: str) -> bytes:
        """Ids of a whole normalised piece as little-endian 32-bit integers."""
        found = self.pieces.get(piece)
        if found is None:
            transducer = PieceTransducer(self.merges)
            ids = transducer.feed(piece.encode("utf-8", "surrogatepass"))
            found = array("I", ids + transducer.finish()).tobytes()
            if len(self.pieces) < self.KEPT and len(piece) <= self.WORD:
                self.pieces[piece] = found
        return found

    def word(self, word: str) -> bytes:
        """Ids of a whole word, before normalisation."""
        text = self.merges.normal(word)
        pieces = self.merges.pattern.findall(text) if text.isascii() else [p for p, _ in self.merges.spans(text)]
        found = b"".join([self.piece(p) for p in pieces])
        if len(self.words) < self.KEPT and len(word) <= self.WORD:
            self.words[word] = found
        return found

    def stream(self, parts: Iterator[str]) -> Iterator[bytes]:
        """Ids of the text that the parts make up, as little-endian 32-bit integers, part by part, in constant memory."""
        rest, going = "", None
        for part in parts:
            rest += part
            while len(rest) > self.PART and (cut := self._cut(rest))[0]:
                done, going = self._part(rest[: cut[0]], going, cut[1])
                yield done
                rest = rest[cut[0] :]
        done, going = self._part(rest, going, True)
        yield done
        if going is not None:
            yield array("I", going.finish()).tobytes()

    def _cut(self, text: str) -> tuple[int, bool]:
        """The last place that parts neither a composed sign nor a special name nor a contraction, and whether no word goes on there; 0 if more text is needed."""
        names = [m.span() for m in self.named.finditer(text)] if self.named else []
        free = lambda at: not any(a < at < b for a, b in names)
        most = len(text) - max(self.longest, 4)
        at = max(text.rfind(" ", most // 2, most), text.rfind("\n", most // 2, most))
        if at > 0 and free(at):
            return at, True
        for at in range(most, 0, -1):
            sign = text[at]
            jamo = "\u1100" <= sign <= "\u11ff"
            joins = not sign.isascii() and (unicodedata.category(sign)[0] != "L" or jamo or unicodedata.normalize("NFC", sign) != sign)
            if not joins and "'" not in text[max(0, at - 2) : at + 1] and free(at):
                return at, False
        return 0, False

    def _part(self, text: str, going: PieceTransducer | None, ends: bool) -> tuple[bytes, PieceTransducer | None]:
        """Ids that are final, and the piece that may go on; ends: no word goes on after the text."""
        out, at = [], 0
        named = self.named is not None and any(name in text for name in self.names)
        for match in self.named.finditer(text) if named else ():
            done, going = self._plain(text[at : match.start()], going, True)
            out += [done, array("I", [self.merges.special[match[0]]]).tobytes()]
            at = match.end()
        done, going = self._plain(text[at:] if at else text, going, ends)
        return b"".join([*out, done]), going

    def _plain(self, text: str, going: PieceTransducer | None, ends: bool) -> tuple[bytes, PieceTransducer | None]:
        if going is None and ends:
            # str.split also splits at four separators that are not white space to the pattern.
            odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
            words = regex.split(r"\p{White_Space}+", text) if odd else text.split()
            kept = self.words
            return b"".join([kept[w] if w in kept else self.word(w) for w in words]), None
        text = self.merges.normal(text)
        spans, out = self.merges.spans(text), array("I")
        for piece, (start, stop) in spans:
            if going is not None and (start or len(self.merges.spans(going.tail + piece)) > 1):
                out.extend(going.finish())
                going = None
            going = going or PieceTransducer(self.merges)
            out.extend(going.feed(piece.encode("utf-8", "surrogatepass")))
            going.tail = (going.tail + piece)[-4:]
            if stop < len(text):
                out.extend(going.finish())
                going = None
        if going is not None and (ends or text and not spans):
            out.extend(going.finish())
            going = None
        return out.tobytes(), going


class IncrementalDecoder:
    """Token ids in parts to text: a state machine over tokens, or over bytes if the file names a byte-level decoder.

    Without a decoder the library joins tokens with spaces; the state is then
    whether a token has come.  With one, the state is an unfinished UTF-8
    sequence; wrong bytes become U+FFFD.
    """

    def __init__(self, merges: MergeList):
        self.merges, self.begun = merges, False
        self.bytes = {s: b for b, s in enumerate(byte_symbols())}
        self.text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        tokens = [self.merges.token[i] for i in ids]
        if not self.merges.joined:
            return self.text.decode(bytes(self.bytes[s] for t in tokens for s in t))
        lead = " " if self.begun and tokens else ""
        self.begun |= bool(tokens)
        return lead + " ".join(tokens)

    def finish(self) -> str:
        return "" if self.merges.joined else self.text.decode(b"", True)


def encoder(path: str, specials: bool) -> StreamingEncoder:
    """One for each worker, with the words that it has met."""
    return worker_held(("word bpe", path, specials), lambda: StreamingEncoder(MergeList(path), specials))


def encode_documents(docs: DataFrame, path: str, specials: bool = True, batch_bytes: int = 4 << 20) -> DataFrame:
    """docs with ids (binary, little-endian unsigned 32-bit integers) and decoded (text of those ids).

    path: the tokenizer file, at the same place on all machines.  specials:
    names of special tokens in a text become those tokens, as the library does
    by default.
    """
    docs = docs.drop("ids", "decoded")
    names, at = docs.columns, docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def coded(own: StreamingEncoder, text: str) -> tuple[bytes, str]:
        decoder, ids, said = IncrementalDecoder(own.merges), [], []
        for part in own.stream(text[k : k + own.PART] for k in range(0, len(text), own.PART)):
            ids.append(part)
            said.append(decoder.feed(memoryview(part).cast("I").tolist()))
        said.append(decoder.finish())
        return b"".join(ids), "".join(said)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, specials)
        for batch in batches:
            start, size, ids, texts = 0, 0, [], []
            for k in range(batch.num_rows):
                row_ids, row_text = coded(own, batch.column(at)[k].as_py() or "")
                ids.append(row_ids)
                texts.append(row_text)
                size += len(row_ids) + len(row_text)
                if size >= batch_bytes or k == batch.num_rows - 1:
                    part = batch.slice(start, k + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary()), pa.array(texts, pa.string())], names=[*names, "ids", "decoded"])
                    start, size, ids, texts = k + 1, 0, [], []

    return docs.mapInArrow(run, schema)


def bpe_report(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text, for every row."""
    coded = encode_documents(docs.select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
