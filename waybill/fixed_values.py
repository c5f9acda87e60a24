"""Constants, names and word lists that results depend on.

They are business decisions, not code: changing one changes what is reported.
"""

# --- fixed values: modelling constants -------------------------------------
SELLER_SMOOTHING_K = 10
NEUTRAL_PRIOR = 0.5
EARTH_RADIUS_KM = 6371.0
CUTOFF_DATE = "2018-06-01"
CANDIDATE_CUTOFFS = ["2018-04-01", "2018-05-01", "2018-06-01", "2018-07-01"]
DECISION_THRESHOLD = 0.60
MIN_PRECISION = 0.20
TOP_SHARE = 0.10
N_TOP_DRIVERS = 3
N_TOP_FEATURES_GLOBAL = 15
N_TOP_FEATURES_LOCAL = 8
CONFIDENCE_THRESHOLD = 0.6
MIN_VOLUME = 30
TOP_N_REGIONS = 10
N_PRIORITY_ORDERS = 50
EXPORT_LIMIT_BYTES = 50 * 1024 * 1024
MARGINAL_THEME_PCT = 3.0

# --- fixed values: calendar and geography bounds ---------------------------
CALENDAR_START = "2016-01-01"
CALENDAR_END = "2019-12-31"
LATITUDE_RANGE = (-34.0, 6.0)
LONGITUDE_RANGE = (-74.0, -28.0)
UNKNOWN_GEO_KEY = "UNKNOWN"
UNKNOWN_CATEGORY = "unknown"

# --- fixed values: columns that may never become features ------------------
FORBIDDEN_FEATURE_COLUMNS = [
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "review_score",
    "is_negative",
    "is_positive",
]
NON_FEATURE_COLUMNS = ["order_id", "date_key", "is_late"]

# --- fixed values: feature columns, in matrix order ------------------------
CATEGORICAL_FEATURE = "dominant_payment_type"
NUMERIC_FEATURES = [
    "seller_late_rate_max",
    "purchase_weekday",
    "purchase_month",
    "purchase_hour",
    "is_weekend",
    "delay_est_days",
    "nb_items",
    "total_price",
    "total_freight",
    "nb_distinct_sellers",
    "freight_ratio",
    "total_payment",
    "nb_payment_installments",
    "product_weight_g_sum",
    "product_volume_cm3_sum",
    "nb_distinct_categories",
    "seller_distance_km_max",
    "geo_is_unknown",
]

# --- fixed values: features of the ablation study --------------------------
ABLATION_SUSPECT = "seller_late_rate_max"
ABLATION_CONTROLS = ["delay_est_days", "purchase_month", "seller_distance_km_max"]

# --- fixed values: risk tiers and driver directions ------------------------
RISK_TIER_LOW = "Sous seuil"
RISK_TIER_ALERT = "Alerte"
RISK_TIER_EXTREME_PREFIX = "Risque extrême"
TIER_LABELS = {"Sous seuil": "Faible", "Alerte": "Modéré"}
TIER_LABEL_EXTREME = "Élevé"
DIRECTION_UP = "retard"
DIRECTION_DOWN = "à l'heure"
DIRECTION_LABELS = {"retard": "augmente le risque", "à l'heure": "réduit le risque"}

# --- fixed values: sentiments and themes -----------------------------------
SENTIMENT_NEGATIVE = "negatif"
SENTIMENT_NEUTRAL = "neutre"
SENTIMENT_POSITIVE = "positif"
THEME_OTHER = "autre"
THEME_NOT_APPLICABLE = "non_applicable"

# --- fixed values: names of model features shown to users ------------------
FEATURE_LABELS = {
    "num__delay_est_days": "Délai de livraison promis",
    "num__seller_distance_km_max": "Distance vendeur-client",
    "num__seller_late_rate_max": "Fiabilité du vendeur",
    "num__total_freight": "Frais de port",
    "num__nb_items": "Nombre d'articles",
    "num__nb_distinct_sellers": "Nombre de vendeurs différents",
    "num__purchase_month": "Mois de l'achat",
    "num__purchase_hour": "Heure de l'achat",
    "num__purchase_weekday": "Jour de la semaine de l'achat",
    "num__is_weekend": "Achat le week-end",
    "num__product_volume_cm3_sum": "Volume du colis",
    "num__product_weight_g_sum": "Poids du colis",
    "num__nb_payment_installments": "Nombre d'échéances de paiement",
    "num__total_price": "Montant de la commande",
    "num__total_payment": "Montant payé",
    "num__freight_ratio": "Part du transport dans le prix",
    "num__geo_is_unknown": "Localisation du client inconnue",
    "num__nb_distinct_categories": "Nombre de catégories de produits",
    "cat__dominant_payment_type_boleto": "Paiement par boleto",
    "cat__dominant_payment_type_credit_card": "Paiement par carte de crédit",
    "cat__dominant_payment_type_voucher": "Paiement par bon d'achat",
    "cat__dominant_payment_type_debit_card": "Paiement par carte de débit",
}

# --- fixed values: state names ---------------------------------------------
STATE_NAMES = {
    "AC": "Acre", "AL": "Alagoas", "AP": "Amapá", "AM": "Amazonas", "BA": "Bahia",
    "CE": "Ceará", "DF": "Distrito Federal", "ES": "Espírito Santo", "GO": "Goiás",
    "MA": "Maranhão", "MT": "Mato Grosso", "MS": "Mato Grosso do Sul",
    "MG": "Minas Gerais", "PA": "Pará", "PB": "Paraíba", "PR": "Paraná",
    "PE": "Pernambuco", "PI": "Piauí", "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte", "RS": "Rio Grande do Sul", "RO": "Rondônia",
    "RR": "Roraima", "SC": "Santa Catarina", "SP": "São Paulo", "SE": "Sergipe",
    "TO": "Tocantins",
}

# --- fixed values: product category labels ---------------------------------
CATEGORY_LABELS = {
    "agro_industry_and_commerce": "Agro-industrie et commerce",
    "air_conditioning": "Climatisation",
    "art": "Art",
    "arts_and_craftmanship": "Artisanat d'art",
    "audio": "Audio",
    "auto": "Automobile",
    "baby": "Bébé",
    "bed_bath_table": "Linge de maison",
    "books_general_interest": "Livres généraux",
    "books_imported": "Livres importés",
    "books_technical": "Livres techniques",
    "cds_dvds_musicals": "CD, DVD et musique",
    "christmas_supplies": "Articles de Noël",
    "cine_photo": "Cinéma et photo",
    "computers": "Ordinateurs",
    "computers_accessories": "Accessoires informatiques",
    "consoles_games": "Consoles et jeux vidéo",
    "construction_tools_construction": "Outillage de construction",
    "construction_tools_lights": "Éclairage de chantier",
    "construction_tools_safety": "Équipement de sécurité chantier",
    "cool_stuff": "Objets tendance",
    "costruction_tools_garden": "Outillage de jardin",
    "costruction_tools_tools": "Outils de bricolage",
    "diapers_and_hygiene": "Couches et hygiène",
    "drinks": "Boissons",
    "dvds_blu_ray": "DVD et Blu-ray",
    "electronics": "Électronique",
    "fashio_female_clothing": "Mode féminine",
    "fashion_bags_accessories": "Sacs et accessoires de mode",
    "fashion_childrens_clothes": "Mode enfant",
    "fashion_male_clothing": "Mode masculine",
    "fashion_shoes": "Chaussures",
    "fashion_sport": "Mode sport",
    "fashion_underwear_beach": "Sous-vêtements et maillots de bain",
    "fixed_telephony": "Téléphonie fixe",
    "flowers": "Fleurs",
    "food": "Alimentation",
    "food_drink": "Alimentation et boissons",
    "furniture_bedroom": "Mobilier chambre",
    "furniture_decor": "Meubles et décoration",
    "furniture_living_room": "Mobilier salon",
    "furniture_mattress_and_upholstery": "Matelas et literie",
    "garden_tools": "Outils de jardin",
    "health_beauty": "Santé et beauté",
    "home_appliances": "Électroménager",
    "home_appliances_2": "Électroménager (autre)",
    "home_comfort_2": "Confort de la maison (autre)",
    "home_confort": "Confort de la maison",
    "home_construction": "Rénovation et construction",
    "housewares": "Articles ménagers",
    "industry_commerce_and_business": "Industrie, commerce et entreprises",
    "kitchen_dining_laundry_garden_furniture": "Cuisine, salle à manger et jardin",
    "la_cuisine": "Cuisine",
    "luggage_accessories": "Bagagerie",
    "market_place": "Marketplace",
    "music": "Musique",
    "musical_instruments": "Instruments de musique",
    "office_furniture": "Mobilier de bureau",
    "party_supplies": "Articles de fête",
    "perfumery": "Parfumerie",
    "pet_shop": "Animalerie",
    "security_and_services": "Sécurité et services",
    "signaling_and_security": "Signalisation et sécurité",
    "small_appliances": "Petit électroménager",
    "small_appliances_home_oven_and_coffee": "Petit électroménager cuisine",
    "sports_leisure": "Sport et loisirs",
    "stationery": "Papeterie",
    "tablets_printing_image": "Tablettes et impression",
    "telephony": "Téléphonie",
    "toys": "Jouets",
    "unknown": "Catégorie inconnue",
    "watches_gifts": "Montres et cadeaux",
}

# --- fixed values: theme labels --------------------------------------------
THEME_LABELS = {
    "retard_livraison": "Retard de livraison",
    "livraison_incomplete": "Livraison incomplète",
    "produit_endommage": "Produit endommagé",
    "produit_incorrect": "Produit incorrect",
}

# --- fixed values: theme patterns, in priority order -----------------------
THEME_PATTERNS = {
    "retard_livraison": [
        r"\batraso",
        r"\bnão.*recebi.*prazo",
        r"\bvenceu.*prazo",
        r"prazo.*venc",
        r"\bfora.*prazo",
        r"\bacima.*prazo",
        r"\bprazo.*não.*cum",
        r"\bdemora",
        r"\blento",
        r"\bperdeu",
        r"\bcorreios.*perderam",
    ],
    "livraison_incomplete": [
        r"\bfaltou",
        r"\bmissing",
        r"\breceber.*menos",
        r"\brecebemos.*menos",
        r"\brecebida?.*incompleta",
        r"\bfalta.*item",
        r"\bfaltam.*item",
        r"\bapenass?.*uma?",
        r"\bapenas.*dois",
        r"\bapenas.*duas",
        r"\bsó.*recebi",
        r"\bsomente.*recebi",
        r"\brecebido?.*só",
        r"\brecebido?.*apenas",
        r"\bchegaram.*\d+",
        r"\bfalta.*uma",
        r"\bfalta.*um",
        r"\bincompleto",
        r"\bitem.*falta",
        r"\bquantidade.*err",
        r"\bquantidade.*meno",
        r"\bchegou.*(apenas|só)",
        r"\brecebi.*(apenas|só|menos)",
        r"\bpedi\s+(um|uma|dois|duas|tr[êe]s|quatro|cinco|seis|sete|oito|nove|dez|\d+)\b",
        r"\bs[óo]\s+veio\b",
        r"\bn[ãa]o\s+receb\w*.*complet",
        r"\bpedi\b.*\breceb(i|emos)\b",
    ],
    "produit_incorrect": [
        r"\bdiferente do anúncio",
        r"\bdiferente do anuncio",
        r"\bproduto diferente",
        r"\bmodelo errado",
        r"\bcor errada",
        r"\bcor diferente",
        r"\bfragrancia diferente",
        r"\bperfume diferente",
        r"\brecebi outro",
        r"\bmandaram uma fragrancia diferente",
        r"\brecebi um produto que não tem nada haver",
        r"\bfoi enviado produto diferente",
        r"\bnão foi o que pedi",
        r"\bnao foi o que pedi",
        r"\brecebi.*(outro|outra|diferente)",
        r"\bproduto.*(errado|diferente)",
    ],
    "produit_endommage": [
        r"\bquebr",
        r"\bromp",
        r"\bfragi",
        r"\bdano",
        r"\bdanado",
        r"\bdefeit",
        r"\bmanutenção",
        r"\bdefeituoso",
        r"\bem.*ruim",
        r"\bproduto.*ruim",
        r"\bqualidade.*péss",
        r"\bpéssima",
        r"\bmal.*embal",
        r"\bestoura",
        r"\bfuro",
        r"\b(estou|tá).*solta",
        r"\bsuja",
        r"\bsujo",
    ],
}

# --- fixed values: the fifth theme tried and dropped in rule exploration ---
EXPLORED_THEME_PATTERNS = {
    "aspect_mismatch": [
        r"\bcor.*escur",
        r"\bcor.*diferent",
        r"\bimagem.*diferent",
        r"\bnão.*igual",
        r"\btamanho.*pequen",
        r"\btamanho.*grand",
        r"\btamanho.*diferen",
        r"\bmaterial.*diferent",
        r"\btextura.*diferent",
        r"\bfoto.*fals",
        r"\bdurabilidade",
    ],
}
