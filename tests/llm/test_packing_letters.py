import public_tokenizers

from marketweave.llm import packing


def test_ids_of_every_code_point_that_is_cut_into_words():
    tokenizer = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    chars = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and not packing._ODD.search(c)]
    assert len(chars) > 300
    texts = [x for c in chars for x in (c, f"a{c}b", f"{c}stanbul", f"x1{c}", f"{c}{c} Z{c}.")] + ["İstanbul", "DİYARBAKIR ve İzmir", "İ"]
    wrong = [t for t, got, want in zip(texts, tokenizer.encode(texts), tokenizer._ids(texts), strict=True) if got != want]
    assert not wrong
