"""Operator 12 token by token: intervals of bytes, one pair of tokens at a time."""

import hashlib
import re
from collections import Counter

import public_tokenizers as public
import sentencepiece
import tokenizers


def byte_alphabet():
    """The printable character that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def counts(docs):
    """docs: (doc_id, text). Sorted tuples in the order of the operator's columns."""
    a_tok = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    byte_of = byte_alphabet()

    def piece(i):
        p = b_tok.id_to_piece(i)
        code = re.fullmatch("<0x([0-9A-F]{2})>", p)
        return bytes([int(code[1], 16)]) if code and b_tok.is_byte(i) else p.replace("▁", " ").encode()

    told, held = [], Counter()
    for doc_id, text in docs:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        ab, bb = [bytes(byte_of[c] for c in a_tok.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not text or not b"".join(ab) == b"".join(bb) == (" " + text).encode():
            told.append((doc_id, None))
            continue
        sa, sb = spans(ab), spans(bb)
        links, low = [], 0
        for i, (start, end) in enumerate(sa):
            while sb[low][1] <= start:
                low += 1
            j = low
            while j < len(sb) and sb[j][0] < end:
                links.append((a[i], b[j]))
                j += 1
        groups, i, j = [], 0, 0
        for cut in sorted({e for _, e in sa} & {e for _, e in sb}):
            ga, gb = [], []
            while i < len(sa) and sa[i][1] <= cut:
                ga.append(str(a[i]))
                i += 1
            while j < len(sb) and sb[j][1] <= cut:
                gb.append(str(b[j]))
                j += 1
            groups.append((ga, gb))
        line = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        told.append((doc_id, (len(a), len(b), len(groups), links, sum(len(x) * len(y) for x, y in groups), hashlib.sha256(line.encode()).hexdigest())))
        held.update(set(links))
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for doc_id, x in told:
        out.append((doc_id, 0, 0, 0, 0, 0, 0, 0, "") if x is None else
                   (doc_id, x[0], x[1], x[2], len(x[3]), x[4], sum(held[p] == top[p[0]] for p in x[3]), sum(held[p] for p in x[3]), x[5]))
    return sorted(out, key=order)


def order(row):
    return row[0] is not None, row[0] or 0, row
