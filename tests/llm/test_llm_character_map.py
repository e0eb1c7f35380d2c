"""The walk through a real character map, against the library: the public model with another normalisation, nothing trained."""

import random

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from recordloom.llm import pieces

ALPHABET = [*"ab ﬁ①½Å　 ㌔ｱﾞ가Ⅷ\t\n​­é漢🙂ﷺ…", "é", "  ", "ﬃ", "が", "<s>"]


def models(rule, squeeze, prefix):
    with open(pieces.model_path(), "rb") as f:
        proto = pb.ModelProto.FromString(f.read())
    given = pb.NormalizerSpec.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec())
    assert len(given.precompiled_charsmap) > 100_000
    spec = proto.normalizer_spec
    spec.precompiled_charsmap, spec.name = given.precompiled_charsmap, rule
    spec.remove_extra_whitespaces, spec.add_dummy_prefix = squeeze, prefix
    blob = proto.SerializeToString()
    return sentencepiece.SentencePieceProcessor(model_proto=blob), pieces.Model(blob)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
def test_equals_the_library(rule, squeeze, prefix):
    library, model = models(rule, squeeze, prefix)
    rng = random.Random(f"{rule}{squeeze}{prefix}")
    for _ in range(1_500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14)))
        ids, lengths, source, decoded = model.encode(text)
        ids = np.frombuffer(ids, "<u4").tolist()
        assert ids == library.encode(text), text
        assert model.decode(ids) == decoded == library.decode(ids), text
        # Every piece lies where the library says, in bytes of the text as given.
        bounds = source[np.cumsum(np.append(0, np.frombuffer(lengths, "<u4")))].tolist() if ids else []
        told = library.encode(text, return_type="proto").pieces
        assert bounds[:-1] == [p.begin for p in told], text
        if told:  # white space that the normalisation drops at the end belongs to the last piece here, to none there
            assert bounds[1:-1] == [p.end for p in told][:-1], text
            assert not text.encode()[told[-1].end :].decode().strip("\u200b\u00ad \u3000\t\n"), text
