"""Constants, word lists, lookup tables and patterns.

Everything in this module is a fixed value that results depend on. Each table
can be replaced by passing another one to the operator that takes it.
"""

from __future__ import annotations

# Decay and signal weights. (group, cap, signal_type, weight)
DECAY_DAYS = 365.0
SIGNAL_WEIGHTS = [
    ("news", 40.0, "news", 10.0),
    ("jobs", 45.0, "job_posting", 15.0),
    ("memberships", 50.0, "sbti", 25.0),
    ("memberships", 50.0, "re100", 25.0),
    ("memberships", 50.0, "ungc", 20.0),
    ("memberships", 50.0, "bcorp", 20.0),
    ("finance", 20.0, "finance", 8.0),
]

# Sampling configuration.
SAMPLE_TOTAL_TARGET = 1200
SAMPLE_MIN_PER_STRATUM = 20
SAMPLE_COUNTRIES = ["AR", "BR", "CL", "CO", "MX", "PE", "UY"]
SAMPLE_INDUSTRIES = [
    "energy_power", "oil_gas", "mining_metals", "chemicals_materials", "manufacturing",
    "construction_realestate", "transport_logistics", "agro_food", "retail_consumer",
    "water_waste_circularity", "finance_insurance", "ict_telecom",
]
SAMPLE_EMPLOYEE_THRESHOLDS = [100, 250]

# Pillar index and prospect-score weights, hot window.
PILLAR_WEIGHTS = {"H": 0.25, "C": 0.20, "F": 0.20, "P": 0.20, "X": 0.15}
PROSPECT_ALPHA = 0.7
PROSPECT_BETA = 0.3
HOT_DAYS = 90

# Countries.
FOCUS_COUNTRIES = ["AR", "BR", "CL", "CO", "PE", "UY", "MX"]
REGION_COUNTRIES = [
    "AR", "BO", "BR", "CL", "CO", "CR", "DO", "EC", "GT",
    "HN", "MX", "NI", "PA", "PE", "PY", "SV", "UY", "VE",
]
ISO2_TO_ISO3 = {
    "AR": "ARG", "BO": "BOL", "BR": "BRA", "CL": "CHL", "CO": "COL", "CR": "CRI",
    "DO": "DOM", "EC": "ECU", "GT": "GTM", "HN": "HND", "MX": "MEX", "NI": "NIC",
    "PA": "PAN", "PE": "PER", "PY": "PRY", "SV": "SLV", "UY": "URY", "VE": "VEN",
}
COUNTRY_TO_ISO2 = {
    "argentina": "AR", "bolivia": "BO", "bolivia (plurinational state of)": "BO",
    "brazil": "BR", "brasil": "BR", "chile": "CL", "colombia": "CO", "costa rica": "CR",
    "dominican republic": "DO", "ecuador": "EC", "el salvador": "SV", "guatemala": "GT",
    "honduras": "HN", "mexico": "MX", "méxico": "MX", "nicaragua": "NI", "panama": "PA",
    "panamá": "PA", "paraguay": "PY", "peru": "PE", "perú": "PE", "uruguay": "UY",
    "venezuela": "VE",
}
MEMBER_LIST_COUNTRY_TO_ISO2 = {
    "argentina": "AR", "brazil": "BR", "brasil": "BR", "chile": "CL", "colombia": "CO",
    "mexico": "MX", "méxico": "MX", "peru": "PE", "perú": "PE", "uruguay": "UY",
    "paraguay": "PY", "bolivia": "BO",
}
COUNTRY_IN_TEXT_TO_ISO2 = {
    "argentina": "AR", "brazil": "BR", "brasil": "BR", "chile": "CL", "colombia": "CO",
    "mexico": "MX", "méxico": "MX", "peru": "PE", "perú": "PE", "uruguay": "UY",
}
RANKING_COUNTRY_ORDER = ["BR", "AR", "CO", "CL", "UY"]
DOMAIN_SUFFIX_COUNTRY = [
    (".com.mx", "MX"), (".mx", "MX"), (".com.br", "BR"), (".br", "BR"),
    (".com.ar", "AR"), (".ar", "AR"), (".com.cl", "CL"), (".cl", "CL"),
    (".com.co", "CO"), (".co", "CO"), (".com.pe", "PE"), (".pe", "PE"),
    (".com.uy", "UY"), (".uy", "UY"),
]
COUNTRY_TEXT_MARKERS = {
    "MX": ["méxico", "mexico", "mexicana", "mexicano", "cdmx", "nuevo león", "yucatán"],
    "AR": ["argentina", "argentino", "buenos aires", "córdoba", "cordoba"],
    "BR": ["brasil", "brasile", "brasileiro", "brasileira", "são paulo", "sao paulo",
           "rio de janeiro"],
    "CL": ["chile", "chilena", "chileno", "santiago"],
    "CO": ["colombia", "colombiana", "colombiano", "bogotá", "bogota"],
    "PE": ["perú", "peru", "peruana", "peruano", "lima"],
    "UY": ["uruguay", "uruguaya", "uruguayo", "montevideo"],
}
LANGUAGE_COUNTRY = {"pt": "BR"}
SCORED_LANGUAGES = ["ENGLISH", "SPANISH", "PORTUGUESE"]

# Name handling.
NAME_STOPWORDS = [
    "de", "del", "la", "las", "los", "el", "y", "the", "grupo", "group", "holding",
    "company", "companies", "corp", "corporation", "inc", "sa", "saa", "sae", "srl",
    "plc", "ltd", "ltda", "co", "cv", "s", "sac", "saic", "spa", "air", "cargo",
]
VARIANT_STOPWORDS = ["de", "la", "el", "do", "da", "del", "y", "the", "of", "and", "para"]
LEGAL_SUFFIX_PATTERN = (
    r"\b(s\.a\.a\.|s\.a\.|sa|ltda|inc|corp|corporación|corporacao|company|compañía|companhia)\b"
)
BANNED_ORGANISATIONS = [
    "gobierno", "ministerio", "naciones unidas", "onu", "ong", "municipalidad",
    "universidad", "capítulo clima", "chapter clima", "capitulo clima", "business travel",
]
# Conservative name repair. (in name, in context, in name alone, replacement)
NAME_REPAIRS = [("del pinar", "del pilar", "Del Pilar Sociedad Anónima")]

# Keywords.
INCLUDE_KEYWORDS = [
    "climate action", "climate initiative", "corporate climate", "acción climática",
    "accion climatica", "net zero", "cero neto", "carbono neutral", "science based targets",
    "transición energética", "transicion energetica", "transición climática",
    "transicion climatica", "renewable energy", "energía renovable", "energia renovable",
    "energía solar", "energia solar", "parque solar", "solar farm", "energía eólica",
    "energia eolica", "parque eolico", "wind farm", "hidrogeno verde", "hidrógeno verde",
    "hydrogen hub", "hydrogen project", "captura de carbono", "carbon capture",
    "emisiones netas", "reducción de emisiones", "carbon reduction", "movilidad electrica",
    "vehiculo electrico", "corredores verdes", "electrificacion industrial",
    "infraestructura verde", "economia circular", "gestión de residuos",
    "gestion de residuos", "residuos cero", "climate finance", "financiamiento climático",
    "financiamiento climatico", "climate investment", "resiliencia climatica",
    "adaptacion climatica", "transporte sostenible", "sostenibilidad corporativa",
    "compromiso climatico", "compromiso climático", "estrategia climatica",
    "estrategia climática", "inversión climática", "inversion climatica",
    "agenda climática", "agenda climatica", "por el clima", "clima", "sostenibilidad",
    "sustentable", "ação climática", "acao climatica", "sustentabilidade",
    "transição energética", "transicao energetica", "climatico", "climática",
]
EXCLUDE_KEYWORDS = [
    "pronostico", "meteorologia", "weather", "tormenta", "lluvia", "nevadas",
    "temperatura", "show de tv", "programa de tv", "reality show", "futbol", "malware",
    "ciberataque", "ciberseguridad", "turismo", "turistico", "viajes", "business travel",
    "activistas", "protesta", "arte", "pintura", "museo", "historia", "colon",
]
SYNONYMS = {
    "climate": ["clima", "cambio climático", "climate action", "climate resilience",
                "resiliencia climática", "adaptación climática", "net zero", "cero neto",
                "neutralidad de carbono"],
    "renewable": ["energía renovable", "energias renovaveis", "renewable energy",
                  "energía limpia", "clean energy", "energía sostenible"],
    "solar": ["fotovoltaica", "solar pv", "paneles solares", "energia solar", "usina solar"],
    "wind": ["energía eólica", "energia eolica", "wind power", "aerogenerador",
             "parque eólico"],
    "hidrogeno": ["hidrógeno verde", "green hydrogen", "hidrogeno verde",
                  "hidrógeno renovable", "hidrogênio verde"],
    "battery": ["almacenamiento de energía", "energy storage", "baterías de litio",
                "lithium ion", "baterias", "storage-as-a-service"],
    "efficiency": ["eficiencia energética", "energy efficiency", "gestión energética",
                   "retrofit", "descarbonización", "decarbonization"],
    "emissions": ["reducción de emisiones", "reducción de CO2", "emisiones netas",
                  "emissões", "carbon footprint", "huella de carbono"],
    "carbono": ["captura de carbono", "carbon capture", "CCUS", "secuestro de carbono",
                "mercado de carbono", "créditos de carbono", "carbon credits"],
    "digital": ["tecnología digital", "digitalización", "digital transformation",
                "tecnologia digital", "smart grid", "sensores IoT", "iot", "gemelo digital"],
    "blockchain": ["web3", "ledger distribuido", "distributed ledger", "tokenización",
                   "tokenization", "blockchain climática"],
    "token": ["token climatico", "carbon token", "token digital", "credit token"],
    "carbono digital": ["mrv digital", "monitoreo remoto", "monitoramento remoto",
                        "satélite carbono", "digital mrv"],
}

# Industry vocabulary.
SIMPLE_INDUSTRY = {
    "agro_food_beverage": "agro_food",
    "agro_food": "agro_food",
    "construction_infrastructure_realestate": "construction_realestate",
    "energy_power_utilities": "energy_power",
    "finance_insurance_capital": "finance_insurance",
    "ict_digital_media": "ict_telecom",
    "industrial_manufacturing": "manufacturing",
    "mining_materials": "mining_metals",
    "retail_consumer_services": "retail_consumer",
    "transport_mobility_logistics": "transport_logistics",
    "oil_gas": "oil_gas",
    "water_waste_circularity": "water_waste_circularity",
    "chemicals_materials": "chemicals_materials",
    "healthcare_pharma_biotech": "healthcare_pharma_biotech",
    "professional_services_consulting": "professional_services_consulting",
    "hospitality_tourism_leisure": "hospitality_tourism_leisure",
    "environmental_circular_services": "environmental_circular_services",
    "public_social_education": "public_social_education",
}
NO_INDUSTRY = "Sin industria"
INDUSTRY_ALIASES = [
    ("healthcare_pharma_biotech", ["biotecnolog", "laboratorio", "hospital", "clinica",
                                   "clínica", "medical", "medica", "médica", "farmaceut",
                                   "farmacéut"]),
    ("retail_consumer_services", ["jumbo", "supermercado", "hipermercado", "shopping",
                                  "tienda", "mall"]),
    ("public_social_education", ["instituto", "fundacion", "fundación", "universidad",
                                 "colegio", "ministerio", "gobierno", "municipio",
                                 "secretaria", "secretaría"]),
]
# Weighted patterns. (pattern, slug, weight), case-insensitive
INDUSTRY_PATTERNS = [
    ("power generation|electric utility|grid operator|distribution company", "energy_power_utilities", 3.0),
    ("energy|energia|renewable|solar|wind|hydro|geothermal|utility", "energy_power_utilities", 2.0),
    ("battery storage|transmission line|photovoltaic", "energy_power_utilities", 1.5),
    ("oil|petro|gas|hidrocarb|hydrocarbon", "oil_gas", 3.0),
    ("refinery|upstream|downstream|pipeline|lng|exploration", "oil_gas", 2.5),
    ("mining|mineral|mineria|minera|mine", "mining_materials", 3.0),
    ("metal|steel|smelter|copper|aluminum|zinc", "mining_materials", 2.0),
    ("pulp|paper|forest product", "mining_materials", 1.5),
    ("manufactur|factory|industrial plant|maquiladora", "industrial_manufacturing", 3.0),
    ("machinery|equipment|component|assembly|automation", "industrial_manufacturing", 2.0),
    ("automotive|auto parts|electronics manufacturing", "industrial_manufacturing", 2.0),
    ("construction|infraestructura|infrastructure|civil works", "construction_infrastructure_realestate", 3.0),
    ("real estate|property developer|inmobiliaria", "construction_infrastructure_realestate", 2.5),
    ("engineering firm|builder|contractor", "construction_infrastructure_realestate", 2.0),
    ("logistic|transporte|transport|supply chain|freight", "transport_mobility_logistics", 3.0),
    ("shipping|maritime|port|aerolinea|airline|aviation", "transport_mobility_logistics", 2.5),
    ("rail|metro|bus|mobility|fleet management", "transport_mobility_logistics", 2.0),
    ("agro|agri|agricultur|farmer|farm|cattle|livestock", "agro_food_beverage", 3.0),
    ("food processing|beverage|dairy|grains|sugar", "agro_food_beverage", 2.5),
    ("fishing|aquaculture|coffee|cacao", "agro_food_beverage", 2.0),
    ("jumbo|supermercad|hipermercad|retail|tienda|mall", "retail_consumer_services", 3.0),
    ("retail|commerce|minoris|tienda|store|mall", "retail_consumer_services", 3.0),
    ("consumer goods|brand|apparel|fashion|cosmetics", "retail_consumer_services", 2.5),
    ("e-?commerce|marketplace|wholesale|distribution", "retail_consumer_services", 2.0),
    ("bank|banking|banco|financiera|financial institution", "finance_insurance_capital", 3.0),
    ("insurance|aseguradora|insurtech|risk", "finance_insurance_capital", 2.5),
    ("investment|asset management|capital markets|private equity|venture", "finance_insurance_capital", 2.0),
    ("software|technology company|it services|digital platform", "ict_digital_media", 3.0),
    ("telecom|telecommunications|telefonia|data center", "ict_digital_media", 2.5),
    ("media|broadcast|streaming|content platform", "ict_digital_media", 2.0),
    ("biotech|biotecnolog|pharma|laboratorio|dispositivo m[eé]dico", "healthcare_pharma_biotech", 3.0),
    ("healthcare|hospital|clinic|medical center", "healthcare_pharma_biotech", 3.0),
    ("pharma|biotech|laboratorio|medical device", "healthcare_pharma_biotech", 2.5),
    ("health services|care provider|telehealth", "healthcare_pharma_biotech", 2.0),
    ("consulting|consultora|asesoria|advisory", "professional_services_consulting", 3.0),
    ("legal services|law firm|accounting|audit", "professional_services_consulting", 2.5),
    ("professional services|design studio|architecture services", "professional_services_consulting", 2.0),
    ("hotel|hospitality|resort|lodging", "hospitality_tourism_leisure", 3.0),
    ("tourism|travel agency|tour operator", "hospitality_tourism_leisure", 2.5),
    ("restaurant|food service|leisure|entertainment venue", "hospitality_tourism_leisure", 2.0),
    ("waste management|recycling|circular economy", "environmental_circular_services", 3.0),
    ("environmental service|carbon market|carbon credit", "environmental_circular_services", 2.5),
    ("remediation|environmental consulting|sustainability service", "environmental_circular_services", 2.0),
    ("instituto|fundaci[oó]n|universidad|colegio|min(isterio)?|gobierno|municipio|secretar[ií]a", "public_social_education", 3.0),
    ("government|ministry|municipal|public sector", "public_social_education", 3.0),
    ("ngo|non-?profit|foundation|cooperative", "public_social_education", 2.5),
    ("education|university|school|research institute", "public_social_education", 2.0),
]
SECTOR_HINTS = [
    ("food producers", "agro_food"),
    ("biotechnology", "healthcare_pharma_biotech"),
    ("retailers", "retail_consumer"),
]
SECTOR_HINT_BONUS = 1.5
CLASSIFY_ACCEPT = 2.0
# Ordered token table.
INDUSTRY_TOKENS = [
    ("energy", "energy_power"), ("utility", "energy_power"), ("power", "energy_power"),
    ("mining", "mining_metals"), ("metal", "mining_metals"), ("smelter", "mining_metals"),
    ("quim", "chemicals_materials"), ("chem", "chemicals_materials"),
    ("manufact", "manufacturing"), ("factory", "manufacturing"),
    ("construct", "construction_realestate"), ("real estate", "construction_realestate"),
    ("logist", "transport_logistics"), ("transport", "transport_logistics"),
    ("shipping", "transport_logistics"), ("agro", "agro_food"), ("agri", "agro_food"),
    ("food", "agro_food"), ("beverage", "agro_food"), ("retail", "retail_consumer"),
    ("consumer", "retail_consumer"), ("supermerc", "retail_consumer"),
    ("mall", "retail_consumer"), ("waste", "water_waste_circularity"),
    ("water", "water_waste_circularity"), ("recycling", "water_waste_circularity"),
    ("bank", "finance_insurance"), ("insur", "finance_insurance"),
    ("capital", "finance_insurance"), ("telecom", "ict_telecom"),
    ("software", "ict_telecom"), ("data center", "ict_telecom"), ("it ", "ict_telecom"),
    ("hospital", "healthcare_pharma_biotech"), ("clinic", "healthcare_pharma_biotech"),
    ("biotech", "healthcare_pharma_biotech"), ("pharma", "healthcare_pharma_biotech"),
    ("medical", "healthcare_pharma_biotech"),
    ("consult", "professional_services_consulting"),
    ("advisory", "professional_services_consulting"),
    ("law", "professional_services_consulting"),
    ("hotel", "hospitality_tourism_leisure"), ("tourism", "hospitality_tourism_leisure"),
    ("travel", "hospitality_tourism_leisure"), ("institut", "public_social_education"),
    ("fundaci", "public_social_education"), ("universidad", "public_social_education"),
    ("minister", "public_social_education"), ("gobiern", "public_social_education"),
    ("municip", "public_social_education"), ("escuela", "public_social_education"),
]
# First-match patterns for member sectors.
SECTOR_PATTERNS = [
    (r"oil|petro|gas|hidrocarb", "oil_gas"),
    (r"energy|energ[ií]a|eléctric|electric|power|solar|fotovoltaic|e[oó]lic|wind|hidro|renew|utilities?", "energy_power"),
    (r"mining|miner|minería|minera|metal|sider", "mining_metals"),
    (r"chem|qu[ií]m|material|plast|poly|fertil|forest and paper products|rubber", "chemicals_materials"),
    (r"construction materials|real estate|inmobili|infraestruct|building|arquitect|engineering|obra", "construction_realestate"),
    (r"transport|log[ií]st|storage|shipping|ferro|a[eé]re|aviaci|metro|rail|trucking|mar[ií]t|portu", "transport_logistics"),
    (r"agri|agro|food|alimento|bev|cervec|brew|café|cafe|cacao|ganad|harin|az[uú]car|fish|forestry", "agro_food"),
    (r"retail|consumer|wholesal|commerce|tienda|supermerc|department|distribu|e-?commerce", "retail_consumer"),
    (r"water|sewer|waste|residu|circular|recicl|sanit|hidric|hydric", "water_waste_circularity"),
    (r"finance|bank|banca|insur|segur|investment|capital|bursatil|microfin|fintech", "finance_insurance"),
    (r"telecom|ict|telefon|software|internet|technolog|digital|comunicaci|media|televis|notic|radio", "ict_telecom"),
    (r"other services", "professional_services"),
    (r"professional|consult|advisory|services? support|technical services|legal|account|auditor|marketing", "professional_services"),
    (r"educat|school|universit|academ|training|learning", "education_research"),
    (r"health|hospital|cl[ií]nic|medical|pharma|biotech|salud", "healthcare"),
    (r"hotel|hospitality|restaurant|leisure|tourism|alojam|lodg|food service", "hospitality_tourism"),
    (r"media|entertainment|publishing|press|television|news|radio|cultural|art", "media_entertainment"),
    (r"government|public policy|publica|municip|minister|state-owned|sector p[uú]blico", "public_sector"),
    (r"non[- ]?profit|ngo|fundaci[oó]n|impacto social", "social_impact"),
    (r"environmental service|sustainability service|carbon market|carbon credit", "environmental_services"),
    (r"manufactured goods|manufactur|industrial|factory|production|automotive|machinery|equipment|textil|apparel|packaging", "manufacturing"),
]
SECTOR_DEFAULT = "other_services"
# Exact sector names, then ordered keyword fallbacks.
SECTOR_EXACT = {
    "technology hardware and equipment": "ict_telecom",
    "software and services": "ict_telecom",
    "media": "ict_telecom",
    "telecommunication services": "ict_telecom",
    "semiconductors and semiconductors equipment": "ict_telecom",
    "healthcare providers and services, and healthcare technology": "ict_telecom",
    "professional services": "ict_telecom",
    "education services": "ict_telecom",
    "specialized consumer services": "retail_consumer",
    "retailing": "retail_consumer",
    "food and staples retailing": "retail_consumer",
    "hotels, restaurants and leisure, and tourism services": "retail_consumer",
    "trading companies and distributors, and commercial services and supplies": "retail_consumer",
    "consumer durables, household and personal products": "manufacturing",
    "textiles, apparel, footwear and luxury goods": "manufacturing",
    "electrical equipment and machinery": "manufacturing",
    "automobiles and components": "manufacturing",
    "building products": "manufacturing",
    "containers and packaging": "manufacturing",
    "construction materials": "manufacturing",
    "healthcare equipment and supplies": "manufacturing",
    "aerospace and defense": "manufacturing",
    "tires": "manufacturing",
    "food and beverage processing": "agro_food",
    "food production - agricultural production": "agro_food",
    "food production - animal source food production": "agro_food",
    "tobacco": "agro_food",
    "real estate": "construction_realestate",
    "homebuilding": "construction_realestate",
    "construction and engineering": "construction_realestate",
    "air freight transportation and logistics": "transport_logistics",
    "air transportation - airport services": "transport_logistics",
    "air transportation - airlines": "transport_logistics",
    "ground transportation - railroads transportation": "transport_logistics",
    "ground transportation - highways and railtracks": "transport_logistics",
    "ground transportation - trucking transportation": "transport_logistics",
    "water transportation - water transportation": "transport_logistics",
    "water transportation - ports and services": "transport_logistics",
    "electric utilities and independent power producers and energy traders (including fossil, alternative and nuclear energy)": "energy_power",
    "solid waste management utilities": "water_waste_circularity",
    "water utilities": "water_waste_circularity",
    "chemicals": "chemicals_materials",
    "pharmaceuticals, biotechnology and life sciences": "chemicals_materials",
    "banks, diverse financials, insurance": "finance_insurance",
    "specialized financial services, consumer finance, insurance brokerage firms": "finance_insurance",
    "mining - iron, aluminum, other metals": "mining_metals",
    "mining - other (rare minerals, precious metals and gems)": "mining_metals",
    "mining - coal": "mining_metals",
    "forest and paper products - forestry, timber, pulp and paper, rubber": "chemicals_materials",
}
SECTOR_KEYWORDS = [
    ("mining", "mining_metals"),
    ("transport|logistic", "transport_logistics"),
    ("agric|food|beverage", "agro_food"),
    ("bank|financial|insurance", "finance_insurance"),
    ("chemical|pharma|biotech", "chemicals_materials"),
    ("energy|power|utilities", "energy_power"),
    ("real estate|construction|homebuilding", "construction_realestate"),
    ("telecom|software|technology|ict", "ict_telecom"),
    ("manufact|equipment|products", "manufacturing"),
    ("waste|water", "water_waste_circularity"),
]
# Company-list pages, ordered keyword groups.
LIST_PAGE_PATTERNS = [
    ("energy|power|renewable|electric|solar|wind|hydro", "energy_power"),
    ("oil|gas|petro|petrol|refiner|upstream|downstream", "oil_gas"),
    ("mining|minera|mineral|metals|steel|aluminum|iron", "mining_metals"),
    ("chemical|chem|fertilizer|plastic|pharma|biotech", "chemicals_materials"),
    ("manufactur|factory|industrial|automotive|auto|machinery|equipment", "manufacturing"),
    ("construct|construction|real estate|inmobili|developer|infrastructure|cement", "construction_realestate"),
    ("transport|logistic|aero|airline|shipping|rail|bus|subway|metro|port|freight", "transport_logistics"),
    ("agro|agric|food|beverage|brew|farm|lácte|meat|dairy|sugar|coffee", "agro_food"),
]
LIST_PAGE_SERVICES = (
    "retail|consumer|store|supermarket|e-commerce|fashion|restaurant|hotel|tourism|media|"
    "telecom|tech|software|digital|bank|finance|insurance|holding"
)
LIST_PAGE_FINANCE = "bank|finance|insurance|fund|holding"
LIST_PAGE_ICT = "telecom|software|digital|tech|media|internet|television|radio|it|ict"
LIST_PAGE_LAST = ("water|waste|recycling|sanitation|environment", "water_waste_circularity")

# Size bands and membership labels.
BCORP_SIZE = {"0": "s", "1-9": "s", "10-49": "s", "50-249": "m", "250-999": "m",
              "250+": "l", "1000+": "l"}
UNGC_SIZE = {"small or medium-sized enterprise": "m", "company": "l"}
MEMBERSHIP_TITLES = {
    "bcorp": "Certificación B Corp",
    "sbti": "Compromiso SBTi",
    "ungc": "Participación Pacto Global",
}
SBTI_SNIPPET = "Compromiso con objetivos basados en ciencia"

# Header priorities for member lists (lower case).
LIST_HEADERS = {
    "member_name": ["company_name", "company", "organization", "organizacion",
                    "organización", "nome", "nombre"],
    "ts": ["date_updated", "date", "fecha", "joined", "approved", "commitment"],
    "country": ["country", "location", "pais", "país"],
    "sector": ["sector", "industry", "categoria"],
}

# Page scoring.
PAGE_TERMS = [
    r"net\s?zero", r"\bESG\b", r"carbon(?!ated)|carb[oó]n(?!ico)",
    r"emissions?|emisiones|emiss[oõ]es", r"renewab|renovabl|renov[aá]vel",
    r"biodivers|nature|naturaleza|natureza", r"climate|clim[aá]tico",
    r"CCUS|carbon capture|captura de carbono", r"\bMRV\b", r"TCFD|TNFD|CDP|ISO\s*14001",
]
PAGE_ANCHOR_PATTERN = "sustainab|sostenib|sustentab|responsab|impact|esg"
TRACKING_PARAMS = ["gclid", "fbclid"]

# Prospect themes.
RENEWABLE_INDUSTRIES = ["energy_power_utilities", "environmental_circular_services"]
RENEWABLE_KEYWORDS = ["renewable", "energia", "energy", "solar", "wind", "hidrogeno",
                      "hydrogen", "fotovolta", "photovolta", "biofuel", "clean energy",
                      "geothermal", "net zero"]
DIGITAL_INDUSTRIES = ["ict_digital_media", "finance_insurance_capital",
                      "professional_services_consulting"]
DIGITAL_KEYWORDS = ["digital", "data", "cloud", "plataforma", "platform", "blockchain",
                    "ai ", "artificial intelligence", "iot", "analytics", "software",
                    "cyber", "smart"]
TARGET_VIEWS = {
    "solar": (["CO"], ["energy_power", "water_waste_circularity"]),
    "digital": (["AR"], ["finance_insurance", "ict_telecom"]),
}

# Display labels by industry key.
INDUSTRY_LABELS = {
    "agro_food": "Agro & alimentos",
    "agro_food_beverage": "Agro & alimentos",
    "agro": "Agro & alimentos",
    "retail_consumer": "Retail & servicios al consumidor",
    "retail_consumer_services": "Retail & servicios al consumidor",
    "retail": "Retail & servicios al consumidor",
    "manufacturing": "Manufactura industrial",
    "industrial_manufacturing": "Manufactura industrial",
    "ict_telecom": "TIC, Digital & Medios",
    "ict_digital_media": "TIC, Digital & Medios",
    "digital_media": "TIC, Digital & Medios",
    "transport_logistics": "Transporte, Movilidad & Logística",
    "transport_mobility_logistics": "Transporte, Movilidad & Logística",
    "construction_realestate": "Construcción, Infraestructura & Bienes Raíces",
    "construction_infrastructure_realestate": "Construcción, Infraestructura & Bienes Raíces",
    "finance_insurance": "Finanzas, Seguros & Capital",
    "finance_insurance_capital": "Finanzas, Seguros & Capital",
    "oil_gas": "Petróleo & gas",
    "energy_power": "Energía & Servicios Públicos",
    "energy_power_utilities": "Energía & Servicios Públicos",
    "utilities": "Energía & Servicios Públicos",
    "health_biotech": "Salud, Pharma & Biotech",
    "hospitality_tourism": "Hospitalidad, Turismo & Ocio",
    "hospitality_tourism_leisure": "Hospitalidad, Turismo & Ocio",
    "mining_metals": "Minería & materiales básicos",
    "mining_materials": "Minería & materiales básicos",
    "professional_services": "Servicios profesionales & técnicos",
    "professional_service_consulting": "Servicios profesionales & técnicos",
    "professional_services_consulting": "Servicios profesionales & técnicos",
    "services_environmental": "Servicios ambientales & circulares",
    "environmental_circular_services": "Servicios ambientales & circulares",
    "water_waste_circularity": "Servicios ambientales & circulares",
    "sector_public": "Sector público, social & educación",
    "public_social_education": "Sector público, social & educación",
    "services_professional_technical": "Servicios profesionales & técnicos",
    "chemicals_materials": "Minería & materiales básicos",
    "healtchare_pharma_biotech": "Salud, Pharma & Biotech",
    "healthcare_pharma_biotech": "Salud, Pharma & Biotech",
}

# Documented label scoring (source weights, source order).
LABEL_SOURCE_WEIGHTS = {"sbti": 3.0, "bcorp": 2.0, "ungc": 1.5, "news": 1.0}
LABEL_REPEAT_DAMPING = 0.5
FALLBACK_SHARE_LIMIT = 0.08

# A small valence lexicon of our own (word -> valence on a -4..4 scale).
VALENCE = {
    "good": 1.9, "great": 3.1, "growth": 1.6, "success": 2.7, "win": 2.8, "benefit": 2.0,
    "improve": 1.9, "award": 2.5, "strong": 2.3, "clean": 1.7, "safe": 1.9, "support": 1.7,
    "progress": 1.8, "leader": 1.5, "innovative": 2.0, "sustainable": 1.4,
    "bueno": 1.9, "crecimiento": 1.6, "logro": 2.0, "mejora": 1.8, "lider": 1.5,
    "avance": 1.7, "bom": 1.9, "sucesso": 2.7,
    "bad": -2.5, "loss": -1.9, "crisis": -3.1, "fraud": -2.8, "fail": -2.5, "failure": -2.3,
    "risk": -1.1, "fine": -0.8, "lawsuit": -1.9, "pollution": -2.3, "spill": -1.8,
    "damage": -2.2, "death": -2.9, "toxic": -2.6, "illegal": -2.6, "delay": -1.3,
    "malo": -2.5, "perdida": -1.9, "fraude": -2.8, "multa": -1.5, "contaminacion": -2.3,
    "derrame": -1.8, "riesgo": -1.1, "poluicao": -2.3,
}
