"""Fixed values for Brazilian public-notice data.

Everything in this module is a constant that the results depend on: word lists,
weights, limits, lookup tables and text patterns. Jobs take these as parameters, so another
country or source brings its own module. Large dimensions (the full term table,
the full host allow-list, municipalities) are not here: they are tables the
caller reads and passes in.
"""

from __future__ import annotations

# ---------------------------------------------------------------- contract
REQUIRED = (
    "id_interno", "municipio", "uf", "data_leilao", "pncp_url", "data_atualizacao",
    "titulo", "descricao", "orgao", "objeto_resumido", "tags", "valor_estimado",
)
SELLABLE = (
    "data_leilao", "pncp_url", "municipio", "uf", "id_interno", "titulo", "descricao",
    "orgao", "tags", "valor_estimado", "data_publicacao",
)
DATE_FIELDS = ("data_leilao", "data_atualizacao", "data_publicacao")
URL_FIELDS = ("pncp_url", "leiloeiro_url")
CRITICAL_URL_FIELDS = ("pncp_url",)
TEXT_AS_URL = ("COMEMORA",)
FORBIDDEN_TAG = "SEM CLASSIFICAÇÃO"
FORBIDDEN_TAGS = ("sync", "leilao", "leilão")

# ---------------------------------------------------------------- relevance
RELEVANCE_BASE = 50
RELEVANCE_MINIMUM = 60
RELEVANCE_WEIGHTS = {
    "sucata": 20, "inservível": 18, "inservivel": 18, "veículo": 15, "veiculo": 15,
    "leilão": 15, "leilao": 15, "alienação": 12, "alienacao": 12, "bem móvel": 10,
    "bem movel": 10, "apreendido": 10, "pátio": 8, "patio": 8, "removido": 8,
    "detran": 12, "der ": 10, "receita federal": 10, "antieconômico": 10,
    "antieconomico": 10, "desfazimento": 10, "custódia": 8, "custodia": 8,
    "fernandoleiloeiro": 8, "fernando leiloeiro": 8, "lopesleiloes": 8, "lopes leilões": 8,
    "joãoemilio": 8, "joaoemilio": 8, "leiloesfreire": 8, "leilões freire": 8,
    "mgrleiloes": 8, "mgr leilões": 8, "kcleiloes": 8, "kc leilões": 8,
    "credenciamento": -50, "pregão": -25, "pregao": -25, "registro de preço": -20,
    "registro de preco": -20, "ata de registro": -20, "habilitação": -15, "habilitacao": -15,
    "qualificação": -15, "qualificacao": -15, "chamamento": -12, "manifesta": -12,
    "contratação": -10, "contratacao": -10, "fornecimento": -10, "prestação": -10,
    "prestacao": -10, "imóvel": -40, "imovel": -40, "imóveis": -40, "imoveis": -40,
    "terreno": -35, "terrenos": -35, "edificio": -35, "edifício": -35, "lote urbano": -30,
    "lote rural": -30, "área urbana": -25, "area urbana": -25, "área rural": -25, "area rural": -25,
}

# ---------------------------------------------------------------- tags
# Used only where the caller's term table is empty.
FALLBACK_TERMS = {
    "VEICULO": [
        "veiculo", "veiculos", "automovel", "automoveis", "carro", "carros", "automotor", "automotivo",
        "volkswagen", "vw", "volks", "chevrolet", "gm", "fiat", "ford", "toyota", "honda", "hyundai",
        "renault", "peugeot", "citroen", "nissan", "mitsubishi", "jeep", "bmw", "audi",
        "gol", "polo", "onix", "prisma", "corsa", "celta", "uno", "palio", "strada", "toro", "hilux",
        "corolla", "civic", "fit", "hb20", "creta", "sandero", "logan", "duster", "ranger", "ecosport",
        "ka", "fiesta", "focus", "voyage", "saveiro", "amarok",
    ],
    "SUCATA": ["sucata", "sucatas", "inservivel", "inserviveis", "ferroso", "ferrosos", "sucateado"],
    "MOTO": [
        "moto", "motos", "motocicleta", "motocicletas", "ciclomotor", "ciclomotores", "motociclo",
        "yamaha", "suzuki", "kawasaki", "triumph", "dafra", "shineray",
        "cg", "titan", "fan", "biz", "bros", "xre", "cb", "twister", "hornet", "pcx", "ybr", "factor",
        "fazer", "lander", "crosser", "nmax", "xtz", "intruder", "yes",
    ],
    "CAMINHAO": [
        "caminhao", "caminhoes", "caminhonete", "camionete", "truck", "trucks", "cavalo mecanico",
        "mercedes-benz", "mercedes", "mb", "scania", "volvo", "iveco", "daf", "man", "agrale",
        "atego", "actros", "axor", "accelo", "constellation", "delivery", "worker", "r440", "r450",
        "fh", "fh460", "vm", "daily", "tector", "stralis", "cargo",
    ],
    "ONIBUS": ["onibus", "microonibus", "micro-onibus", "micro onibus", "marcopolo", "caio", "busscar", "neobus"],
    "CARRETA": [
        "carreta", "carretas", "semi-reboque", "semirreboque", "reboque", "reboques",
        "implemento rodoviario", "randon", "facchini", "guerra", "librelato", "noma",
    ],
    "MAQUINARIO": [
        "maquina", "maquinas", "trator", "tratores", "retroescavadeira", "escavadeira",
        "pa carregadeira", "carregadeira", "motoniveladora", "patrol",
        "caterpillar", "cat", "john deere", "jd", "massey ferguson", "massey", "mf", "valtra",
        "new holland", "nh", "case", "jcb",
    ],
    "DOCUMENTADO": ["documentado", "documentados", "com documento", "documento ok"],
    "APREENDIDO": ["apreendido", "apreendidos", "patio", "removido", "removidos", "custodia"],
}
CATEGORY_TAG = "IMOVEL"
CATEGORY_KEEP = ("VEICULO", "SUCATA", "MOTO", "CAMINHAO", "ONIBUS")

# ---------------------------------------------------------------- listing feed
FEED_TAG_WORDS = {
    "CARRO": ["carro", "automovel", "automóvel", "sedan", "hatch", "suv"],
    "MOTO": ["moto", "motocicleta", "motociclo", "scooter"],
    "CAMINHAO": ["caminhao", "caminhão", "truck", "carreta"],
    "ONIBUS": ["onibus", "ônibus", "micro-onibus"],
    "TRATOR": ["trator", "tratores", "colheitadeira"],
    "REBOQUE": ["reboque", "semirreboque", "carretinha"],
    "VEICULO": ["veiculo", "veículo", "placa", "chassi", "renavam"],
    "SUCATA": ["sucata", "sucatas", "inservivel", "inservível", "lote de peças"],
    "DOCUMENTADO": ["documentado", "com documento", "com documentação"],
    "SEM_DOCUMENTO": ["sem documento", "sem documentação", "documentação pendente"],
    "APREENDIDO": ["apreendido", "apreensão"],
}
FEED_DEFAULT_TAG = "OUTROS"
FEED_SCRAP_WORD = "sucata"
FEED_VEHICLE_WORDS = (
    "veículo", "veiculo", "carro", "moto", "motocicleta", "caminhão", "caminhao", "ônibus",
    "onibus", "automóvel", "automovel", "chassi", "placa", "renavam", "trator", "reboque",
    "carreta", "van", "utilitário", "pickup", "fiat", "volkswagen", "vw", "chevrolet", "gm",
    "ford", "honda", "yamaha", "toyota", "hyundai", "jeep", "nissan", "mercedes", "bmw", "audi",
    "peugeot", "citroen", "renault", "scania", "volvo", "iveco", "man", "daf", "kia", "mitsubishi",
)
FEED_CATEGORY_INCLUDE = (
    "veiculo", "veículo", "carro", "moto", "caminhao", "caminhão", "onibus", "ônibus",
    "trator", "sucata", "automóvel", "automovel",
)
FEED_CATEGORY_EXCLUDE = (
    "imovel", "imóvel", "apartamento", "casa", "terreno", "sala", "lote urbano", "loja",
    "galpao", "galpão", "fazenda",
)
REJECTION_TEXT = {
    "TIPO_3": ("Leilão tipo 3 (híbrido) não suportado pelo escopo", "error"),
    "MISSING_DATA_LEILAO": ("Campo obrigatório data_leilao ausente", "error"),
    "MISSING_TAGS": ("Campo obrigatório tags ausente ou vazio", "error"),
    "INVALID_UF": ("UF inválida ou não reconhecida", "error"),
    "MISSING_ID_INTERNO": ("Falha ao gerar id_interno", "error"),
    "INVALID_TITULO": ("Título ausente ou inválido", "error"),
    "DUPLICATE_CONTENT": ("Conteúdo duplicado (mesmo content_hash)", "info"),
    "API_ERROR": ("Erro ao buscar dados da API", "error"),
    "PARSE_ERROR": ("Erro ao parsear resposta da API", "error"),
    "CATEGORY_EXCLUDED": ("Categoria excluída do escopo (ex: imóveis)", "info"),
    "EXPIRED_AUCTION": ("Leilão já encerrado", "info"),
}
EMPTY_TITLES = ("undefined", "null", "none", "")

# ---------------------------------------------------------------- lot pages
PAGE_TAG_WORDS = {
    "SUCATA": ["sucata", "sucatas", "lata", "inservível", "inservivel"],
    "DOCUMENTADO": ["documentado", "com documento", "licenciado"],
    "SEM_DOCUMENTO": ["sem documento", "sem documentação", "sem documentacao"],
    "CARRO": ["carro", "automóvel", "automovel", "sedan", "hatch", "suv"],
    "MOTO": ["moto", "motocicleta", "motoneta", "scooter"],
    "CAMINHAO": ["caminhão", "caminhao", "truck", "cavalo mecânico"],
    "ONIBUS": ["ônibus", "onibus", "micro-ônibus", "microonibus"],
    "TRATOR": ["trator", "máquina agrícola", "maquina agricola"],
    "REBOQUE": ["reboque", "carreta", "semirreboque"],
}
PAGE_VEHICLE_HINTS = (
    "veículo", "veiculo", "carro", "moto", "motocicleta", "caminhão", "caminhao", "ônibus",
    "onibus", "automóvel", "automovel", "sucata", "sucatas", "chassi", "placa", "renavam",
    "trator", "reboque", "carreta", "fiat", "volkswagen", "vw", "chevrolet", "gm", "ford",
    "honda", "yamaha", "toyota", "hyundai", "jeep", "nissan", "mercedes", "bmw", "audi",
    "peugeot", "citroen", "renault", "scania", "volvo", "iveco", "man", "daf",
)
PAGE_CATEGORY_WORDS = (
    ("imovel", (
        "imóvel", "imovel", "apartamento", "casa", "terreno", "loteamento", "sala comercial",
        "prédio", "predio", "galpão", "galpao", "fazenda", "sítio", "sitio", "chácara", "chacara",
    )),
    ("veiculo", (
        "veículo", "veiculo", "carro", "automóvel", "automovel", "caminhão", "caminhao", "moto",
        "motocicleta", "van", "ônibus", "onibus", "reboque", "cavalo mecânico", "placa", "renavam", "chassi",
    )),
    ("sucata", (
        "sucata", "sucatas", "peças", "pecas", "desmontagem", "batido", "sinistrado",
        "inservível", "inservivel", "carcaça", "carcaca",
    )),
    ("veiculo", (
        "fiat", "volkswagen", "vw", "chevrolet", "gm", "ford", "honda", "yamaha", "toyota",
        "hyundai", "jeep", "nissan", "mercedes", "bmw", "audi", "peugeot", "citroen", "renault",
        "scania", "volvo", "iveco", "man", "mitsubishi", "kia",
    )),
)
IMAGE_SKIP_WORDS = ("logo", "icon", "avatar", "placeholder")

# ---------------------------------------------------------------- regions
REGION_NAMES = {
    "acre": "AC", "alagoas": "AL", "amapa": "AP", "amazonas": "AM", "bahia": "BA", "ceara": "CE",
    "distrito federal": "DF", "espirito santo": "ES", "goias": "GO", "maranhao": "MA",
    "mato grosso": "MT", "mato grosso do sul": "MS", "minas gerais": "MG", "para": "PA",
    "paraiba": "PB", "parana": "PR", "pernambuco": "PE", "piaui": "PI", "rio de janeiro": "RJ",
    "rio grande do norte": "RN", "rio grande do sul": "RS", "rondonia": "RO", "roraima": "RR",
    "santa catarina": "SC", "sao paulo": "SP", "sergipe": "SE", "tocantins": "TO",
}
REGIONS = tuple(sorted(set(REGION_NAMES.values())))
FEDERAL_WORDS = (
    "ministério", "ministerio", "receita federal", "união", "uniao", "federal", "nacional",
    "brasil", "ibama", "inss", "antt", "anac", "anvisa", "banco central", "cgu", "dnit", "funai", "incra",
)
FEDERAL_REGION = "DF"

# ---------------------------------------------------------------- links
# Used only where the caller's host table is empty.
FALLBACK_HOSTS = (
    "lfranca.com.br", "bidgo.com.br", "sodresantoro.com.br", "superbid.net", "superbid.com.br",
    "vipleiloes.com.br", "frfranca.com.br", "lancenoleilao.com.br", "leilomaster.com.br", "lut.com.br",
    "zfrancaleiloes.com.br", "amaralleiloes.com.br", "bfranca.com.br", "cronos.com.br",
    "confederacaoleiloes.com.br", "megaleiloes.com.br", "leilaoseg.com.br", "cfrancaleiloes.com.br",
    "estreladaleiloes.com.br", "sold.com.br", "mitroleiloes.com.br", "alifrancaleiloes.com.br",
    "hastavip.com.br", "klfrancaleiloes.com.br", "centraldosleiloes.com.br", "dfranca.com.br",
    "rfrancaleiloes.com.br", "sfranca.com.br", "clickleiloes.com.br", "petroleiloes.com.br",
    "pfranca.com.br", "clfranca.com.br", "tfleiloes.com.br", "kfranca.com.br", "lanceja.com.br",
    "portalleiloes.com.br", "wfrancaleiloes.com.br", "rafaelfrancaleiloes.com.br",
    "alfrancaleiloes.com.br", "jfrancaleiloes.com.br", "mfranca.com.br", "msfranca.com.br",
    "stfrancaleiloes.com.br", "ofrancaleiloes.com.br", "hmfrancaleiloes.com.br", "abataleiloes.com.br",
    "webleilao.com.br", "gfrancaleiloes.com.br", "lleiloes.com.br", "lanceleiloes.com.br",
    "lopesleiloes.net.br", "lopesleiloes.com.br",
)
IGNORED_HOST_PARTS = (
    "pncp.gov.br", "gov.br", "comprasnet", "google.com", "facebook.com", "instagram.com",
    "youtube.com", "twitter.com", "linkedin.com", "whatsapp.com", ".pdf", ".doc", ".xls", ".jpg", ".png",
)
MAIL_HOSTS = (
    "hotmail.com", "hotmail.com.br", "yahoo.com", "yahoo.com.br", "gmail.com", "outlook.com",
    "uol.com.br", "bol.com.br", "terra.com.br", "ig.com.br", "globo.com", "msn.com", "live.com", "icloud.com",
)
RELEVANT_LINK_WORDS = (
    "leilao", "leilão", "leiloes", "leilões", "franca", "bid", "lance", "sold", "hasta",
    "arremate", "arrematacao",
)
RELEVANT_LINK_SUFFIXES = (".com.br", ".net.br")
HOST_CORRECTIONS = {
    "lanceleiloes.com": "www.lanceleiloes.com.br",
    "lanceleiloes.com.br": "www.lanceleiloes.com.br",
    "superbid.net": "www.superbid.net",
}
GLUED_TLD = r"(?i)[A-Za-z0-9]\.(?:com|net|org|br|gov|edu|io|co)[A-Za-z]"
KNOWN_TLDS = (".com.br", ".net.br", ".org.br", ".gov.br", ".com", ".net", ".org")
AGENCY_URLS = (
    (("receita federal", "rfb", "secretaria da receita"), "http://www25.receita.fazenda.gov.br/sle-sociedade/portal"),
)
NOTICE_LINK_BASE = "https://pncp.gov.br/app/editais/"
COMPLIANT_LINK = r"/editais/\d{14}/\d{4}/\d+$"

# ---------------------------------------------------------------- source scoring
OFFICIAL_POINTS = {
    "HTTPS": 5, "HTTP200": 5, "GOV_BR": 30, "DETRAN": 20, "KEYWORDS": 15, "EDITAL_REF": 15, "ORGAO_REF": 10,
}
OFFICIAL_MINIMUM = 70
AGENCY_HOSTS = tuple(f"detran.{uf.lower()}.gov.br" for uf in REGIONS)
NOTICE_REFERENCE = r"(?iu)(edital|processo|leilao|leilão|pregao|pregão)\s*n[°ºo]?\s*\d+"
AGENCY_REFERENCE = (
    r"(?iu)(comiss[aã]o\s+de\s+leil[aã]o|comiss[aã]o\s+permanente|denatran|senatran|secretaria\s+de|"
    r"minist[eé]rio\s+|tribunal\s+|receita\s+federal|pol[ií]cia\s+federal|pol[ií]cia\s+rodovi[aá]ria)"
)
BLOCKED_WORDS = (
    "captcha", "cloudflare", "login required", "acesso negado", "javascript required",
    "habilite javascript", "enable javascript", "403 forbidden", "401 unauthorized",
)
HOST_CLASSES = (
    ("DETRAN", AGENCY_HOSTS),
    ("FEDERAL_RFB", ("receita.fazenda.gov.br", "gov.br/receitafederal")),
    ("FEDERAL_POLICIA", ("gov.br/pf", "gov.br/prf")),
    ("FEDERAL_COMPRAS", ("pncp.gov.br", "compras.gov.br")),
    ("GOV_BR_OUTRO", (".gov.br",)),
    ("DIARIO_OFICIAL", ("in.gov.br", "imprensaoficial")),
)
OTHER_HOST_CLASS = "OUTRO"
BINARY_EXTENSIONS = ("pdf", "jpg", "jpeg", "png", "gif", "mp4", "mp3", "zip", "doc", "xls")
CRAWL_DEPTH = 2
CRAWL_PAGES_PER_SEED = 300

# ---------------------------------------------------------------- lots in documents
SCANNED_BELOW_CHARS = 100
EARLY_TABLE_PAGE = 3
TABLE_WORDS = (
    "lote", "item", "placa", "chassi", "renavam", "marca", "modelo", "veiculo", "descricao",
    "avaliacao", "valor", "lance",
)
TABLE_SKIP_WORDS = (
    "largura", "altura", "espessura", "assinatura", "testemunha", "cnpj", "razao social",
    "data encerramento", "data abertura", "horario abertura", "horario encerramento",
)
COLUMN_ROLES = (
    ("descricao", ("descricao", "especificacao", "objeto")),
    ("numero", ("lote", "item", "n.", "nº", "numero")),
    ("valor", ("valor", "avaliacao", "preco", "lance", "minimo")),
    ("placa", ("placa",)),
    ("chassi", ("chassi",)),
    ("renavam", ("renavam",)),
    ("marca", ("marca",)),
    ("modelo", ("modelo",)),
    ("ano", ("ano",)),
)
BRANDS = (
    "MERCEDES-BENZ", "MERCEDES", "VOLKSWAGEN", "VW", "CHEVROLET", "GM", "FIAT", "FORD", "TOYOTA",
    "HONDA", "HYUNDAI", "RENAULT", "NISSAN", "JEEP", "BMW", "AUDI", "PEUGEOT", "CITROEN",
    "MITSUBISHI", "KIA", "SUZUKI", "YAMAHA", "SCANIA", "VOLVO", "IVECO", "MAN", "DAF", "AGRALE",
    "MARCOPOLO", "COMIL", "MASCARELLO", "CAIO", "NEOBUS",
)
NOT_A_PLATE = ("ANO", "COR", "CEP", "UNO", "GOL", "KIA", "RUA", "NUM")

# ---------------------------------------------------------------- modality
MODALITY_BOTH, MODALITY_ONLINE, MODALITY_ONSITE = "Híbrido", "Eletrônico", "Presencial"
ONLINE_WORDS = (
    "eletrônico", "eletronico", "online", "internet", "virtual", "plataforma digital",
    "meio eletrônico", "forma eletrônica", "site", "portal", "sistema eletrônico",
)
ONSITE_WORDS = (
    "presencial", "sede", "auditório", "auditorio", "sala", "comparecimento", "in loco",
    "endereço", "endereco", "local do leilão", "local do leilao",
)
MODALITY_CODES = {6: "Eletrônico", 7: "Presencial"}

# ---------------------------------------------------------------- run limits and cost
QUARANTINE_WARNING, QUARANTINE_CRITICAL = 15, 30
LONG_RUN_SECONDS = 1800
STALE_HOURS = 2
IDLE_RUNS = 3
PRICE_PER_DOCUMENT, PRICE_PER_ROW, PRICE_PER_TOKEN = "0.001", "0.0005", "0.00001"
PRICE_INPUT_MILLION, PRICE_OUTPUT_MILLION = "0.15", "0.60"
PLAN_BASE, PLAN_PER_GB = "25", "0.125"
SLO_SUCCESS, SLO_FRESH_HOURS, SLO_INTEGRITY, SLO_DOWNLOAD = 95, 24, 90, 99
PAGE_SIZE, AUDIT_LIMIT, AUDIT_MAX = 20, 50, 100
DEFAULT_VIEW = (-15.0, -55.0, 4.0)

# ---------------------------------------------------------------- states and their legal moves
ALERT_MOVES = frozenset({
    ("open", "acknowledged"), ("open", "resolved"), ("acknowledged", "resolved"), ("open", "discarded"), ("acknowledged", "discarded"), ("resolved", "open"),
})
QUARANTINE_MOVES = frozenset({("pending", "resolved"), ("pending", "discarded")})

# ---------------------------------------------------------------- listing cards
CARD_MAKES = "FIAT|VW|VOLKSWAGEN|GM|CHEVROLET|FORD|HONDA|YAMAHA|TOYOTA|HYUNDAI|RENAULT|PEUGEOT|CITROEN|NISSAN|SUZUKI|KIA|JEEP|BMW"
#: Fields of a vehicle card, by the site they are read from: patterns with one group each.
CARD_FIELDS = {
    "detran_mg": {
        "vehicle": rf"(?i)((?:{CARD_MAKES})[/\s]+[A-Z0-9 .\-]+)",
        "price": r"R\$\s*([\d.,]+)",
        "model_year": r"\b(19[89]\d|20[0-2]\d)\b",
        "category": r"(?iu)(Sucata|Conservado|Recuperável)",
        "plate": r"\b([A-Z]{3}-?\d[A-Z0-9]\d{2})\b",
        "lot": r"(?iu)lote\s*(?:n[ºo°.]?\s*)?(\d{1,4})",
    },
    "sodre_santoro": {
        "vehicle": rf"(?i)((?:{CARD_MAKES})[/\s]+[A-Z0-9 .\-]+?)(?=\s+\d{{2}}/\d{{2}}|\s*<)",
        "price": r"R\$\s*([\d.,]+)",
        "model_year": r"\b(\d{2}/\d{2}|19[89]\d|20[0-2]\d)\b",
        "category": r"(?iu)(Sucata|Conservado|Recuperável)",
        "yard": r"(?iu)p[áa]tio[:\s]+([^<]{3,})",
        "lot_url": r"href=\"([^\"]*/lote/\d+[^\"]*)\"",
        "lot": r"/lote/(\d+)",
        "image": r"<img[^>]*src=\"([^\"]+)\"",
    },
}
