import random
from hashlib import sha256

import public_tokenizers
from tokenizers import Tokenizer

from abyssal.llm.bpe import TokenAutomaton, decoder, digests, encoder, read_vocabulary, tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a", "AİB ΣΣ", "été", "don't we'll I'M x'VE", "<|endoftext|>a<|startoftext|> <|END", "1234 ٣ ½", "a b c\x85d\x1cz​",
       "\U0001f600\U0001f468‍\U0001f469 中文 हि", "!!!??***", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\x00\x01", "ﬁ Å ẞ", "ab" * 3000]


def reference():
    return Tokenizer.from_file(PATH)


def test_like_the_library():
    t, a, rng = reference(), TokenAutomaton(read_vocabulary(PATH)), random.Random(3)
    texts = list(ODD)
    for letters in ("ab", "etaoin srhld", "theandingrs", "abcdefghijklmnopqrstuvwxyz'.,!-éßœ", "lo!. 'σΣAEIOU0189"):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x370, 0x2000), rng.randrange(0x3000, 0xA000)])) for _ in range(20)) for _ in range(300)]
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert a.encode(text) == e.ids, text
        assert a.decode(e.ids) == t.decode(e.ids, skip_special_tokens=False)


def test_spark_round_trip(spark):
    t = reference()
    rows = [(i, x) for i, x in enumerate(ODD)] + [(None, None), (3, "a"), (3, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = sorted((len(i), sha256(" ".join(map(str, i)).encode()).hexdigest(), sha256(t.decode(i, skip_special_tokens=False).encode()).hexdigest())
                  for i in (t.encode(x or "", add_special_tokens=False).ids for _, x in rows))
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(docs, PATH).collect()) == want
    ids = docs.withColumn("ids", encoder(spark, PATH)("text"))
    back = ids.withColumn("back", decoder(spark, PATH)("ids")).collect()
    assert all(r.back == t.decode(t.encode(r.text or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in back)
    assert digests(docs.limit(0), PATH).collect() == []
    both = docs.withColumn("r", tokenizer(spark, PATH)("text")).select("text", "r.*").collect()
    assert all((r.token_ids, r.decoded) == (i := t.encode(r.text or "", add_special_tokens=False).ids, t.decode(i, skip_special_tokens=False)) for r in both)


def test_batches_beside_other_stages_are_small(spark):
    """Ids and decoded text of a batch take a multiple of its bytes in every worker of an executor."""
    tokenizer(spark, PATH)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 1 << 20


def test_pieces_between_white_space_like_the_library():
    """What a task remembers by pieces is what the whole text gives, with all white space, marks after it and special tokens."""
    t, a, rng = reference(), TokenAutomaton(read_vocabulary(PATH), 50), random.Random(4)
    parts = [*" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0    ​   　", "́", "̧", "e", "Σ", "ΑΣ", "İ", "don't", "X,", "ᄀ", "ᅡ",
             "12", "<|endoftext|>", "<|ENDOFTEXT|>", "word", "ab" * 40]
    texts = ["", " ", "\x1c", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(3000))]
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert a.texts(text) == (" ".join(map(str, e.ids)), t.decode(e.ids, skip_special_tokens=False)), text
        assert a.encode(text) == e.ids


def test_few_arcs_are_tried_for_a_word():
    class Counting(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    a, rng = TokenAutomaton(read_vocabulary(PATH)), random.Random(5)
    a.readable = Counting(a.readable)
    for word in ("".join(rng.choice("etaoinshrdlu") for _ in range(30)) for _ in range(200)):
        a.encode_word(word)
    assert a.readable.asked < 200 * 30 * 6
