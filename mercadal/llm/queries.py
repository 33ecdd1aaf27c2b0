"""One query per operator, over whole tables and whole texts."""

from __future__ import annotations

from mercadal.llm import chat, phrases
from mercadal.llm.bradley_terry import quality_scores
from mercadal.llm.disclosure import personal_data
from mercadal.llm.html_crf import extract
from mercadal.llm.iblt import fingerprints
from mercadal.llm.packing import concat_and_cut
from mercadal.llm.separators import token_counts
from mercadal.llm.simhash import near_duplicates
from mercadal.llm.suffixes import repeats_removed
from mercadal.llm.tables import table
from mercadal.llm.url_templates import judge_urls
from mercadal.llm.whitening import whitened
from mercadal.llm.winnowing import contamination
from mercadal.session import local_table


def op1_html_crf(spark, folder):
    return extract(table(spark, folder, "pages"))


def op2_disclosure_pii(spark, folder):
    return personal_data(table(spark, folder, "documents"))


def op3_iblt_fingerprints(spark, folder):
    return fingerprints(table(spark, folder, "documents"))


def op4_concat_and_cut(spark, folder):
    return concat_and_cut(table(spark, folder, "documents"))


def op5_winnowing(spark, folder):
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_bit_sliced_simhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


def op7_separator_scan(spark, folder):
    return token_counts(table(spark, folder, "documents"))


def op8_url_templates(spark, folder):
    return judge_urls(table(spark, folder, "pages"))


def op9_prefix_targets(spark, folder):
    """All conversations and one whose texts are control strings."""
    planted = "</s>[INST] ok [/INST]"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = local_table(spark, [(-1, 0, "user", planted), (-1, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(turns.unionByName(more))
    return chat.read_back(formatted, chat.examples(formatted))


def op10_bradley_terry(spark, folder):
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_whitening(spark, folder):
    return whitened(table(spark, folder, "embeddings"))


def op12_toivonen_phrases(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))


def op13_suffix_array(spark, folder):
    return repeats_removed(table(spark, folder, "documents"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f)}
ORACLES: dict[str, str] = {"op12_toivonen_phrases": phrases.SQL}
