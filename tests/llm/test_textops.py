from __future__ import annotations

import re

import frames
import pyarrow as pa

from salesloom.llm import textops


def test_parts_of_a_batch_give_the_words_of_their_texts():
    texts = [t for _, t, *_ in frames.rows()] + ["Ünï ÀB c", None, ""] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    for limit in (1, 60, 700, 1 << 20):
        found = []
        for part in textops.slices([batch, batch.slice(3, 9)], "text", limit):
            lower = textops.lower_ascii(textops.strings(part.column("text")))
            lower.validate(full=True)
            words = textops.Words(lower)
            flat = words.flat.to_pylist()
            found += [flat[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
        wanted = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts + texts[3:12]]
        fold = lambda w: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
        assert found == [[fold(w) for w in own] for own in wanted]
