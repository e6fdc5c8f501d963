"""Fill-in-the-middle by big-integer bit-parallelism.

A text's bytes are translated to the digits 0 and 1 of a class and read as one big
integer, a bit a byte, the first byte highest. Tokens end where a word byte's
successor is none, ``words & ~(words << 1)``, and at the text's end; ``bit_count`` of
these ends is the number of tokens, and the k-th end is found by halving: the bits in
the upper half are counted, and one half goes on. Blanks are ASCII, so bytes do for
tokens, and a second class (bytes that begin a code point) turns byte positions into
code points.

The transformation is one pass over the rows without a shuffle; the identifier's hash decides
all, so reruns agree. Restoring is a DataFrame expression on the output and its form.

Defined results: null text is as empty text, 0 tokens, plain; a null identifier hashes as the empty string;
rows that repeat an identifier are cut each by their own text; an empty table gives no rows; columns of
other names are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_BLANK = {0x20, *range(0x09, 0x0E)}
#: Digits of the two classes: bytes of words, and bytes that begin a code point.
WORDS = bytes(b"01"[x not in _BLANK] for x in range(256))
BEGINS = bytes(b"01"[x & 0xC0 != 0x80] for x in range(256))
#: Bytes of output a batch, about.
BATCH = 4 << 20


def mask(data: bytes, kind: bytes) -> int:
    """A bit a byte, the first byte highest."""
    return int(data.translate(kind), 2) if data else 0


def token_ends(data: bytes) -> int:
    """The mask of the last bytes of all tokens: words with the blanks before them, and blanks at the end."""
    words = mask(data, WORDS)
    return (words & ~(words << 1)) | (1 if data else 0)


def select(bits: int, width: int, k: int) -> int:
    """How many of ``width`` bits, from the highest, reach to the k-th set one (0 for k = 0)."""
    done = 0
    while k and width > 1:
        low = width >> 1
        high = bits >> low
        n = high.bit_count()
        if k <= n:
            bits, width = high, width - low
        else:
            k, done = k - n, done + width - low
            bits, width = bits & ((1 << low) - 1), low
    return done + width if k else 0


def cut(data: bytes, doc_id: int | None, seed: int = 42, rate: int = 50, spm: int = 80) -> tuple[int, str, int | None, int | None, bytes]:
    """Tokens, form, code points of prefix and middle, and the output of one text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    ends = token_ends(data)
    n = ends.bit_count()
    if not data or h[2] % 100 >= rate or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, data
    a, b = (select(ends, len(data), k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    begins = mask(data, BEGINS)
    chars = lambda to: (begins >> (len(data) - to)).bit_count()
    before = chars(a)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h[3] % 100 < spm:
        return n, "spm", before, chars(b) - before, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", before, chars(b) - before, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def transformed(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of each row of (doc_id, text); ``rate`` percent are cut, ``spm`` percent of these with the suffix first."""
    import pyarrow as pa

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

    def batch(rows):
        ids, n, form, prefix, middle, output = zip(*rows, strict=True)
        whole = lambda x: pa.array(x, pa.int64())
        return pa.RecordBatch.from_arrays([whole(ids), whole(n), pa.array(form, pa.string()), whole(prefix), whole(middle), pa.array(output, pa.binary()).cast(pa.string())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    def run(batches):
        for b in batches:
            rows, size = [], 0
            for doc_id, text in zip(b.column(0), b.column(1).cast(pa.binary()), strict=True):
                own = doc_id.as_py()
                rows.append((own, *cut(text.as_py() or b"", own, seed, rate, spm)))
                size += len(rows[-1][-1])
                if size > BATCH:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of :func:`transformed` was made of."""
    part = lambda k: F.get(F.split(output, "<[PSM]>"), F.lit(k))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """All documents, and the digests of their outputs and of the texts rebuilt from them."""
    rows = transformed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = r"""
with h as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as x,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as t
  from documents),
k as (
  select *, len(t)::bigint as n, ('0x' || substr(x, 1, 8))::bigint as h1, ('0x' || substr(x, 9, 8))::bigint as h2,
         ('0x' || substr(x, 17, 8))::bigint as h3, ('0x' || substr(x, 25, 8))::bigint as h4
  from h),
c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
              when h4 % 100 < 80 then 'spm' else 'psm' end as form
  from k),
p as (
  select *, array_to_string(t[1:a], '') as prefix, array_to_string(t[a + 1:b], '') as middle, array_to_string(t[b + 1:], '') as suffix from c)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars, case when form <> 'plain' then length(middle) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""
