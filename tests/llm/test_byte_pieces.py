import base64
import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from frames import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarflow.llm.byte_pieces import BytePieces, byte_pieces

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = BytePieces(open(PATH, "rb").read(), public_tokenizers.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aabcdethsing  \n.,'=-1é日"), st.characters(exclude_categories=["Cs"])), max_size=200))
def test_ids_are_the_library_s(text):
    ids = PIECES.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert PIECES.decode(ids) == text.encode()


def test_long_words():
    for text in ("a" * 3000, "ab" * 2000, " " * 3000 + "x", "=-" * 1500, "9" * 3000):
        assert np.frombuffer(PIECES.encode(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)


def test_rows(spark):
    docs = awkward(spark)
    found = byte_pieces(docs, PATH, public_tokenizers.PATTERN).collect()
    wanted = []
    for doc, text in [(r.doc_id, r.text or "") for r in docs.collect()]:
        ids = np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()
        wanted.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids))
    assert sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids)) for r in found], key=repr) == sorted(wanted, key=repr)
    assert byte_pieces(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0
