"""Fixed values shared by the operators.

Everything in this file is data: names, ids, patterns and limits that results depend on.
Ids differ between model checkpoints, so every operator takes them as parameters and only
uses these as defaults.
"""

# Column names searched, in this order, for the language of a row.
LANGUAGE_COLUMNS = ("language", "lang", "locale", "lang_id", "voice_language")

# Column names searched, in this order, for the rejected codes of a preference row.
REJECTED_CODE_COLUMNS = (
    "dispreferred_audio_codes",
    "rejected_audio_codes",
    "generated_audio_codes",
    "reject_audio_codes",
)

# Language spellings folded into one name.
LANGUAGE_ALIASES = {
    "japanese": ("ja", "jpn", "jp", "japanese", "ja-jp", "ja_jp"),
    "korean": ("ko", "kor", "kr", "korean", "ko-kr", "ko_kr"),
}

# Fixed value: language given to every row of the URL-voice source.
SOURCE_B_LANGUAGE = "korean"

# Fixed value: file name used when a URL has no last path segment.
FETCH_FALLBACK_NAME = "arknights_%d.wav"

# Token ids of the text and codec channels (defaults).
TTS_PAD, TTS_BOS, TTS_EOS = 151671, 151672, 151673
CODEC_PAD, CODEC_BOS, CODEC_EOS = 4196, 4197, 4198
CODEC_THINK, CODEC_NOTHINK = 4202, 4203
CODEC_THINK_BOS, CODEC_THINK_EOS = 4204, 4205
LABEL_IGNORE = -100
CODEBOOKS = 16
RESERVED_TAIL = 1024

# Chat templates around a text.
ASSISTANT_HEAD = "<|im_start|>assistant\n"
USER_HEAD = "<|im_start|>user\n"
TURN_END = "<|im_end|>\n"

# Audio arithmetic.
SAMPLES_PER_FRAME = 1920
CODEC_RATE = 24000
ASR_HOP = 160

# Chunked decoding.
CHUNK_FRAMES, CHUNK_CONTEXT = 300, 25

# Batching and sharding.
ENCODE_BATCH = 32
LENGTH_RATIO = 4.0
SHARD_BYTES = 4831838208
SHARD_BLOCK_ROWS = 65536

# Resume search.
TAIL_ROWS, ANCHOR_KEYS = 200, 5

# Generation parameters used when neither the request nor the file sets one.
GENERATION_DEFAULTS = {
    "do_sample": "true",
    "top_k": "50",
    "top_p": "1.0",
    "temperature": "0.9",
    "repetition_penalty": "1.05",
    "subtalker_dosample": "true",
    "subtalker_top_k": "50",
    "subtalker_top_p": "1.0",
    "subtalker_temperature": "0.9",
    "max_new_tokens": "2048",
}

# Running-average codebook training.
EMA_DECAY, EMA_EPSILON, DEAD_CODE_SHARE = 0.99, 1e-5, 2.0
KMEANS_ROUNDS = 10

# Preference objective.
PREFERENCE_BETA = 0.1
