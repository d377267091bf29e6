"""Settings of the corpus pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Source:
    """One named input: which column holds its text and its share of the token budget."""

    name: str
    weight: float
    field: str = "text"

    def token_budget(self, budget_b: float) -> int:
        return int(budget_b * 1e9 * self.weight)


# The defaults below, on which the rules' results depend.
@dataclass(frozen=True)
class PipelineConfig:
    # budget
    token_budget_b: float = 3.548
    chars_per_token: float = 4.65
    sources: tuple[Source, ...] = field(default=(Source("case-law", 0.33, "document"), Source("sec", 0.43), Source("fineweb-edu", 0.24)))
    chunk_docs: int = 200
    shard_target: int = 256 * 1024 * 1024
    # cleaning
    min_line_chars: int = 40
    max_non_alnum_ratio: float = 0.30
    min_doc_chars: int = 600
    ngram_n: int = 4
    repetition_top_k: int = 10
    max_repetition_ratio: float = 0.50
    language_prefix_chars: int = 5000
    min_ascii_ratio: float = 0.90
    min_ocr_tokens: int = 20
    max_ocr_word_ratio: float = 0.02
    ocr_filter: bool = True
    # dedup and decontamination
    n_perm: int = 64
    n_bands: int = 8
    jaccard: float = 0.80
    shingle_words: int = 5
    max_shingles: int = 4096
    contam_ngram: int = 13
    contam_min_hits: int = 5
    minhash_sources: tuple[str, ...] | None = ("case-law",)
    seed: int = 1337
    # tokenizer and packing
    vocab_size: int = 16384
    sample_gb: float = 3.0
    seq_len: int = 1024
    val_every: int = 100
    # model shape, schedule, retention
    n_layer: int = 12
    d_model: int = 768
    d_ffn: int = 3072
    micro_batch: int = 32
    grad_accum: int = 4
    n_gpu: int = 4
    epochs: int = 5
    lr_peak: float = 6e-4
    lr_min: float = 6e-5
    warmup_steps: int = 500
    eval_batches: int = 100
    patience: int = 5
    keep_checkpoints: int = 3
    early_stop_sources: tuple[str, ...] = ("case-law", "fineweb-edu")

    @property
    def rows_per_band(self) -> int:
        return self.n_perm // self.n_bands

    @property
    def windows_per_step(self) -> int:
        return self.micro_batch * self.grad_accum * self.n_gpu

    @property
    def tokens_per_step(self) -> int:
        return self.windows_per_step * self.seq_len


#: Ids 0..6, in order.
SPECIAL_TOKENS = ("<|bos|>", "<|eos|>", "<|pad|>", "<|unk|>", "<|user|>", "<|assistant|>", "<|system|>")
EOS_ID = 1
DEFAULT = PipelineConfig()
