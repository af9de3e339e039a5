"""Which rules a cleaning run applies."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class CleanConfig:
    """Every rule is off unless switched on; the order of execution is fixed."""

    # sessions and corpus
    no_utter_dup: bool = False
    re_name: bool = False
    split_multi_repost: bool = False
    no_toupiao: bool = False
    no_short_response: bool = False
    no_ad: bool = False
    de_generic_dialog: bool = False
    # utterances
    no_specific_utter: bool = False
    de_reply_tag: bool = False
    de_angle: bool = False
    de_url: bool = False
    de_weibo_url: bool = False
    de_brackets: bool = False
    de_lenticular: bool = False
    de_hashtag: bool = False
    de_emotion: bool = False
    de_html: bool = False
    no_mention: bool = False
    de_mention: bool = False
    de_single_repost_mention: bool = False
    de_repost: bool = False
    de_showall: bool = False
    de_emoji: bool = False
    de_alpha_num: bool = False
    de_specific: bool = False
    de_phone: bool = False
    de_qq: bool = False
    cleantext_clean: bool = False
    bert_clean: bool = False
    contain_zh: bool = False
    no_special_topic: bool = False
    no_str_blacklist: bool = False
    de_duplicated: bool = False
    no_short: bool = False
    no_long: bool = False
    # words
    no_alpha_noise: bool = False
    check_confuse_word: bool = False
    no_word_blacklist: bool = False
    yda_dedupl: bool = False
    # parameters
    audit: bool = True
    scope: str = "corpus"
    min_turns: int = 1
    ad_min_len: int = 20
    ad_min_contexts: int = 2
    generic_min_count: int = 1000
    block_turns: int = 1024

    def on(self, *flags: str) -> CleanConfig:
        return replace(self, **{f: True for f in flags})

    def off(self, *flags: str) -> CleanConfig:
        return replace(self, **{f: False for f in flags})

    @property
    def word_level(self) -> bool:
        return self.no_alpha_noise or self.check_confuse_word or self.no_word_blacklist or self.yda_dedupl

    @property
    def joins(self) -> bool:
        """Is any rule on that joins the utterances with a lexicon?"""
        return self.no_special_topic or self.no_str_blacklist or self.no_alpha_noise or self.no_word_blacklist

    @property
    def later_passes(self) -> bool:
        return self.re_name or self.no_ad or self.de_generic_dialog

    @staticmethod
    def flags() -> tuple[str, ...]:
        return tuple(f.name for f in fields(CleanConfig) if f.type == "bool" and f.name != "audit")

    @staticmethod
    def basic() -> CleanConfig:
        """Lexicon, control characters, text normalisation, phone and account numbers."""
        return CleanConfig().on("no_str_blacklist", "bert_clean", "cleantext_clean", "de_phone", "de_qq")

    @staticmethod
    def full() -> CleanConfig:
        """The broad profile for web text, without a lexicon."""
        return CleanConfig().on(
            "split_multi_repost", "de_reply_tag", "de_hashtag", "de_single_repost_mention", "de_duplicated",
            "de_emoji", "bert_clean", "cleantext_clean", "no_specific_utter", "no_toupiao", "de_url",
            "de_weibo_url", "contain_zh", "no_mention", "de_showall", "de_brackets", "de_specific", "de_phone",
            "de_qq", "de_alpha_num",
        )
