"""Fixed values of the domain.

Everything in this module is data that has to equal the values found in the
incoming files (labels, codes, state abbreviations) or the published scale of
the score.  Nothing here is computed.
"""

# Settlement codes and their readable meaning.
SETTLEMENT_MEANING = {
    "0": "Full interbank settlement",
    "1": "Full intrabank settlement",
    "5": "Full settlement at assignor request",
    "6": "Full settlement via protest",
    "7": "Full settlement by term expiry",
    "8": "Full settlement at destination institution request",
    "9": "Full interbank settlement via STR",
}

# Codes that close a receivable without money changing hands.
NON_FINANCIAL_CODES = ("5", "6", "7", "8")

# Settlement labels as they appear in the files.
SETTLEMENT_LABELS = (
    "0 - Baixa integral interbancaria",
    "1 - Baixa integral intrabancaria",
    "5 - Baixa integral por solicitacao do cedente",
    "6 - Baixa integral por envio para protesto",
    "7 - Baixa integral por decurso de prazo",
    "8 - Baixa integral por solicitacao da instituicao destinataria",
    "9 - Baixa integral interbancaria - Liquidacao via STR",
)

# Instrument labels as they appear in the files.
INSTRUMENT_LABELS = (
    "DM DUPLICATA MERCANTIL",
    "DMI DUPLICATA MERCANTIL INDICACAO",
    "DS DUPLICATA DE SERVICO",
    "DSI DUPLICATA DE SERVICO INDICACAO",
    "ME MENSALIDADE ESCOLAR",
    "NF NOTA FISCAL",
    "NP NOTA PROMISSORIA",
    "CARTAO DE CREDITO",
    "OUTROS",
)

# Brazilian state codes.
STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO",
    "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR",
    "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)

# Text tokens a CSV reader treats as a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# The eight external company scores, shared by both roles.
COMPANY_SCORES = (
    "sacado_indice_liquidez_1m",
    "cedente_indice_liquidez_1m",
    "score_materialidade_evolucao",
    "media_atraso_dias",
    "indicador_liquidez_quantitativo_3m",
    "share_vl_inad_pag_bol_6_a_15d",
    "score_quantidade_v2",
    "score_materialidade_v2",
)

# Business thresholds.
DEFAULT_THRESHOLD_DAYS = 0        # official label: later than the due date
LOW_BELOW = 0.3                   # probability scale; times 100 on the score scale
MEDIUM_BELOW = 0.6
NULL_RATE_FACTOR = 2.0            # null-rate alarm: max(factor x base, base + margin)
NULL_RATE_MARGIN = 0.05
MATCH_RATE_SLACK = 0.01

# Weights of the rule-based score.
WEIGHT_DELAY, WEIGHT_OVERDUE, WEIGHT_ILLIQUIDITY, WEIGHT_MATERIALITY = 35, 25, 20, 20

# Alert rules and texts.
ALERT_ENTITY_TYPE = "Cedente"
ALERT_SCORE_CRITICAL = 75
ALERT_DEFAULT_RATE = 0.5
ALERT_SCORE_HIGH = 60
ALERT_KINDS = {
    # kind: (alert_type, level, status)
    "critical": ("Score", "Critico", "Aberto"),
    "overdue": ("Inadimplencia", "Alerta", "Em analise"),
    "exposed": ("Concentracao", "Atencao", "Aberto"),
}
ALERT_TEXT_CRITICAL = ("Score preditivo em ", "/1000 com exposicao de R$ ", ".")
ALERT_TEXT_OVERDUE = ("Inadimplencia observada de ", "% na entidade.")
ALERT_TEXT_EXPOSED = ("Entidade em alto risco com score ", "/1000.")

# Display names of the risk bands and of the aging buckets.
RISK_DISPLAY = {"low": "Baixo", "medium": "Medio", "high": "Alto"}
AGING_LABELS = ("Em dia", "1-15d", "16-60d", ">60d", "Aberto")

# Display names of model inputs.
FEATURE_DISPLAY = {
    "payer_score_materialidade_v2": "Materialidade do pagador",
    "payer_score_quantidade_v2": "Quantidade do pagador",
    "payer_score_materialidade_evolucao": "Evolucao da materialidade",
    "payer_sacado_indice_liquidez_1m": "Liquidez 1m do pagador",
    "beneficiary_cedente_indice_liquidez_1m": "Liquidez 1m do cedente",
    "beneficiary_sacado_indice_liquidez_1m": "Liquidez do sacado no cedente",
    "beneficiary_media_atraso_dias": "Atraso medio do cedente",
    "payer_media_atraso_dias": "Atraso medio do pagador",
    "due_day_of_week": "Dia da semana do vencimento",
    "boleto_term_days": "Prazo do boleto",
    "vlr_nominal": "Valor nominal do boleto",
    "default_probability": "Probabilidade de inadimplencia",
    "risk_score": "Score de risco",
}
FEATURE_PREFIX_DISPLAY = {
    "payer_": "Pagador - ",
    "beneficiary_": "Cedente - ",
    "boleto_": "Boleto - ",
}

# Names of the economic divisions (first two CNAE digits).
CNAE_DEFAULT_NAME = "Setor CNAE"
CNAE_DIVISIONS = {
    "01": "Agricultura, pecuaria e servicos relacionados",
    "02": "Producao florestal",
    "03": "Pesca e aquicultura",
    "05": "Extracao de carvao mineral",
    "06": "Extracao de petroleo e gas natural",
    "07": "Extracao de minerais metalicos",
    "08": "Extracao de minerais nao-metalicos",
    "09": "Apoio a extracao mineral",
    "10": "Fabricacao de produtos alimenticios",
    "11": "Fabricacao de bebidas",
    "12": "Fabricacao de produtos do fumo",
    "13": "Fabricacao de produtos texteis",
    "14": "Confeccao de artigos do vestuario",
    "15": "Preparacao de couros e calcados",
    "16": "Produtos de madeira",
    "17": "Celulose, papel e produtos de papel",
    "18": "Impressao e reproducao",
    "19": "Coque e derivados de petroleo",
    "20": "Produtos quimicos",
    "21": "Produtos farmoquimicos e farmaceuticos",
    "22": "Produtos de borracha e plastico",
    "23": "Produtos de minerais nao-metalicos",
    "24": "Metalurgia",
    "25": "Produtos de metal",
    "26": "Equipamentos de informatica e eletronicos",
    "27": "Maquinas e equipamentos eletricos",
    "28": "Maquinas e equipamentos",
    "29": "Veiculos automotores",
    "30": "Outros equipamentos de transporte",
    "31": "Moveis",
    "32": "Produtos diversos",
    "33": "Manutencao e instalacao",
    "35": "Eletricidade, gas e utilidades",
    "36": "Captacao e distribuicao de agua",
    "37": "Esgoto e atividades relacionadas",
    "38": "Coleta e tratamento de residuos",
    "39": "Descontaminacao e gestao ambiental",
    "41": "Construcao de edificios",
    "42": "Obras de infraestrutura",
    "43": "Servicos especializados para construcao",
    "45": "Comercio e reparacao de veiculos",
    "46": "Comercio por atacado",
    "47": "Comercio varejista",
    "49": "Transporte terrestre",
    "50": "Transporte aquaviario",
    "51": "Transporte aereo",
    "52": "Armazenagem e atividades auxiliares",
    "53": "Correio e entregas",
    "55": "Alojamento",
    "56": "Alimentacao",
    "58": "Edicao e publicacao",
    "59": "Audiovisual e musica",
    "60": "Radio e televisao",
    "61": "Telecomunicacoes",
    "62": "Tecnologia da informacao",
    "63": "Servicos de informacao",
    "64": "Servicos financeiros",
    "65": "Seguros e previdencia",
    "66": "Atividades auxiliares financeiras",
    "68": "Atividades imobiliarias",
    "69": "Atividades juridicas e contabeis",
    "70": "Consultoria e gestao empresarial",
    "71": "Arquitetura, engenharia e testes",
    "72": "Pesquisa e desenvolvimento",
    "73": "Publicidade e pesquisa de mercado",
    "74": "Atividades profissionais e tecnicas",
    "75": "Atividades veterinarias",
    "77": "Alugueis nao-imobiliarios",
    "78": "Selecao e locacao de mao de obra",
    "79": "Agencias de viagens",
    "80": "Seguranca e investigacao",
    "81": "Servicos para edificios e paisagismo",
    "82": "Servicos de escritorio e apoio administrativo",
    "84": "Administracao publica",
    "85": "Educacao",
    "86": "Atencao a saude humana",
    "87": "Atencao residencial em saude",
    "88": "Assistencia social",
    "90": "Artes e espetaculos",
    "91": "Bibliotecas, museus e patrimonio",
    "92": "Jogos de azar e apostas",
    "93": "Esporte, recreacao e lazer",
    "94": "Organizacoes associativas",
    "95": "Reparacao de computadores e pessoais",
    "96": "Outras atividades de servicos pessoais",
    "97": "Servicos domesticos",
    "99": "Organismos internacionais",
}
