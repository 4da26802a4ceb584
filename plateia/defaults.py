"""Fixed values. They decide results, so they are stated here once, as plain text."""

from __future__ import annotations

# Category names and the labels the tables carry.
CANDIDATE_CATEGORY = "candidato"
PRESS_CATEGORY = "imprensa"
UNKNOWN_CATEGORY = "desconhecido"
BYPASS_MARKER = "[todos_vídeos_candidato]"
NOT_MENTIONED = "Não Mencionado"
MENTION_TYPES = ("candidato", "vice")

# Sentiments and emotions; the emotion order also breaks ties.
SENTIMENTS = ("POSITIVO", "NEGATIVO", "NEUTRO")
EMOTIONS = ("ENTUSIASMO", "ESPERANCA", "NEUTRO", "RAIVA", "TRISTEZA", "DECEPCAO")
POSITIVE_EMOTIONS = ("ENTUSIASMO", "ESPERANCA")
NEGATIVE_EMOTIONS = ("RAIVA", "TRISTEZA", "DECEPCAO")

# Emotion lexicon, matched as accent-free substrings.
EMOTION_LEXICON = {
    "ENTUSIASMO": [
        "incrivel", "adorei", "excelente", "maravilhoso", "genial", "fantastico",
        "show", "top", "demais", "otimo", "bom", "melhor",
    ],
    "ESPERANCA": [
        "espero", "esperanca", "acredito", "confianca", "vai dar", "vai ser",
        "torco", "acreditar", "vencer", "ganhar", "vai vencer",
    ],
    "RAIVA": [
        "odio", "raiva", "odeio", "furioso", "indignado", "revoltado", "agressivo",
        "miseravel", "horrivel", "pessimo", "nojo",
    ],
    "TRISTEZA": [
        "triste", "tristeza", "choro", "chorei", "devastado", "deprimido", "infeliz",
        "desanimado", "perdeu", "fracasso", "nao acredito", "nao posso",
    ],
    "DECEPCAO": [
        "decepcionado", "decepcao", "esperava", "esperava mais", "frustrado",
        "desapontado", "desiludido",
    ],
}

# Emotion scores by star rating when no usable keyword occurs.
EMOTION_FALLBACK = {
    5: {"ENTUSIASMO": 0.8, "ESPERANCA": 0.2},
    4: {"ENTUSIASMO": 0.3, "ESPERANCA": 0.7},
    2: {"RAIVA": 0.2, "TRISTEZA": 0.3, "DECEPCAO": 0.5},
    1: {"RAIVA": 0.5, "TRISTEZA": 0.3, "DECEPCAO": 0.2},
}

# Accented letters the emotion lexicon ignores, and their bases.
EMOTION_ACCENTED = "áàâãéêíóôõúç"
EMOTION_PLAIN = "aaaaeeiooouc"

# Classifier defaults.
CLASSIFIER_MODEL = "nlptown/bert-base-multilingual-uncased-sentiment"
CLASSIFIER_BATCH = 32

# Default channels.
CHANNELS = [
    {"source": "Ciro Gomes", "category": "candidato", "identifier": "@CiroGomesOficial"},
    {"source": "Diário do Nordeste", "category": "imprensa", "identifier": "@diariodonordeste"},
    {"source": "Elmano de Freitas", "category": "candidato", "identifier": "@elmanodefreitas"},
    {"source": "O POVO", "category": "imprensa", "identifier": "@opovo"},
]

# Default relevance terms, as (type, label, term).
_TERMS = [
    ("candidato", "Ciro Gomes", "ciro gomes"),
    ("candidato", "Ciro Gomes", "ciro governador"),
    ("candidato", "Ciro Gomes", "ciro 45"),
    ("candidato", "Ciro Gomes", "ciro"),
    ("candidato", "Ciro Gomes", "bora cirar"),
    ("candidato", "Ciro Gomes", "onda azul"),
    ("vice", "Ciro Gomes", "roberto claudio"),
    ("candidato", "Elmano de Freitas", "elmano"),
    ("candidato", "Elmano de Freitas", "elmano de freitas"),
    ("vice", "Elmano de Freitas", "gabriella aguiar"),
    ("candidato", "Danilo Soares", "danilo soares"),
    ("vice", "Danilo Soares", "eryck veloso"),
    ("candidato", "Delegado Huggo", "delegado huggo"),
    ("candidato", "Delegado Huggo", "huggo leonardo"),
    ("vice", "Delegado Huggo", "felipe moreira"),
    ("candidato", "Ieri Braga", "ieri braga"),
    ("vice", "Ieri Braga", "laerte silva"),
    ("candidato", "Serley Leal", "serley leal"),
    ("vice", "Serley Leal", "catherine teles"),
    ("candidato", "Vera Lúcia", "vera lucia"),
    ("vice", "Vera Lúcia", "capitao amilton gomes"),
    ("candidato", "Zé Batista", "ze batista"),
    ("vice", "Zé Batista", "ivonete"),
    ("termo_eleicao", "", "governador"),
    ("termo_eleicao", "", "eleicao 2026"),
    ("termo_eleicao", "", "eleicoes 2026"),
    ("termo_eleicao", "", "programa eleitoral"),
    ("termo_eleicao", "", "propaganda eleitoral"),
    ("termo_eleicao", "", "candidato a governador"),
    ("termo_eleicao", "", "ceara governador"),
    ("termo_eleicao", "", "voto"),
    ("termo_eleicao", "", "urna"),
    ("termo_eleicao", "", "debate"),
    ("termo_eleicao", "", "governo"),
    ("termo_eleicao", "", "carreata"),
    ("termo_eleicao", "", "comite"),
    ("termo_eleicao", "", "comitê"),
    ("termo_eleicao", "", "eleitor"),
    ("termo_eleicao", "", "eleitores"),
    ("termo_eleicao", "", "onda da mudança"),
    ("termo_eleicao", "", "onda da mudanca"),
    ("termo_eleicao", "", "libertação do ceará"),
    ("termo_eleicao", "", "libertacao do ceara"),
]
RELEVANCE_TERMS = [{"type": kind, "label": label, "term": term} for kind, label, term in _TERMS]

# Gold artifacts a run needs before reports may read it.
REQUIRED_GOLD = (
    "comments_with_sentiment",
    "candidatos_manifestacoes",
    "temas_engajamento",
    "comentarios_gold_enriched",
    "candidatos_timeline",
    "canais_timeline",
)
