"""Term lists, weights and patterns that the scores are defined by.

Terms are matched as substrings of lower-cased text, so short ones also hit inside longer words; that is part of the definitions.
"""

from __future__ import annotations

# ---- Fixed values: geographic content score -------------------------------------------------------------------------
INSTITUTIONS = [
    "presidencia de méxico", "gobierno de méxico", "gob.mx", "presidencia.gob.mx", "cámara de diputados", "senado de la república",
    "congreso de la unión", "suprema corte de justicia", "scjn", "tribunal electoral", "tepjf", "instituto nacional electoral", "ine",
    "conacyt", "conapred", "secretaría de", "semar", "sedena", "shcp", "sre", "sep", "universidad nacional autónoma de méxico", "unam", "ipn",
    "colmex", "colegio de méxico", "itesm", "tecnológico de monterrey", "uam", "universidad autónoma metropolitana", "ciesas", "el colegio de",
    "poder judicial de la federación", "consejo de la judicatura", "tribunal superior de justicia", "fiscalía general de la república",
    "instituto nacional de bellas artes", "inba", "conaculta", "consejo nacional para la cultura", "instituto nacional de antropología", "inah",
    "fondo de cultura económica", "fce",
]
STATES = [
    "aguascalientes", "baja california", "baja california sur", "campeche", "chiapas", "chihuahua", "coahuila", "colima", "durango",
    "guanajuato", "guerrero", "hidalgo", "jalisco", "méxico", "michoacán", "morelos", "nayarit", "nuevo león", "oaxaca", "puebla", "querétaro",
    "quintana roo", "san luis potosí", "sinaloa", "sonora", "tabasco", "tamaulipas", "tlaxcala", "veracruz", "yucatán", "zacatecas",
    "ciudad de méxico", "cdmx", "distrito federal",
]
CITIES = [
    "ciudad de méxico", "guadalajara", "monterrey", "puebla", "tijuana", "león", "juárez", "torreón", "querétaro", "san luis potosí", "mérida",
    "mexicali", "aguascalientes", "cuernavaca", "saltillo", "hermosillo", "culiacán", "durango", "toluca", "morelia", "villahermosa",
    "tuxtla gutiérrez", "pachuca", "xalapa", "veracruz", "cancún", "acapulco", "mazatlán", "puerto vallarta", "playa del carmen",
]
VOCABULARY = [
    "peso mexicano", "pesos", "centavos", "banxico", "banco de méxico", "ahorita", "órale", "güey", "neta", "chido", "padre", "padrísimo",
    "gacho", "fresa", "naco", "chilango", "defeño", "regiomontano", "tapatío", "poblano", "jarocho", "yucateco", "norteño", "sureño", "antro",
    "cantina", "pulquería", "merendero", "fondita", "tianguis", "mercado sobre ruedas", "ambulantaje", "tacos", "tamales", "pozole", "mole",
    "chiles en nogada", "cochinita pibil", "tequila", "mezcal", "pulque", "tepache", "horchata", "agua fresca", "día de muertos",
    "día de los muertos", "posadas", "quinceañera", "mariachi", "jarabe tapatío", "folklor mexicano", "lucha libre", "pri", "pan", "prd",
    "morena", "mcl", "amlo", "lópez obrador", "sheinbaum", "claudia sheinbaum", "andrés manuel", "cuarta transformación", "4t", "mañaneras",
    "conferencia matutina", "palacio nacional", "los pinos", "residencia oficial", "zócalo capitalino", "templo mayor", "revolución mexicana",
    "independencia de méxico", "benito juárez", "miguel hidalgo", "josé maría morelos", "emiliano zapata", "pancho villa", "lázaro cárdenas",
    "sor juana inés", "frida kahlo", "diego rivera", "octavio paz", "carlos fuentes", "juan rulfo", "elena poniatowska",
]
URL_DOMAINS = [
    ".mx", ".gob.mx", ".org.mx", ".edu.mx", ".com.mx", "unam.mx", "ipn.mx", "colmex.mx", "ciesas.edu.mx", "scjn.gob.mx", "diputados.gob.mx",
    "senado.gob.mx", "presidencia.gob.mx", "gob.mx",
]
PHONE = r"\b(?:\+52|52)?\s*(?:\d{2}\s*)?(?:\d{4}\s*\d{4}|\d{3}\s*\d{3}\s*\d{4})\b"
AREA_PHONE = r"\b(?:55|81|33|222|664|656|614|618|867|844|477|442|461|777|443|686|998|984)\s*\d{3}\s*\d{4}\b"
POSTAL = r"\b(?:C\.P\.?\s*)?(?:0[1-9]|[1-9]\d)\d{3}\b"
PESOS = r"(?i)\$\s*\d+(?:\.\d{2})?\s*(?:pesos?|mxn|mx)"
MEXICAN_PESOS = r"(?i)\d+(?:\.\d{2})?\s*pesos?\s*mexicanos?"
REGIONS = {
    "centro": ["chilango", "defeño", "ciudad de méxico", "cdmx", "distrito federal", "toluca", "estado de méxico", "cuernavaca", "pachuca"],
    "norte": ["regiomontano", "monterrey", "nuevo león", "tijuana", "chihuahua", "hermosillo", "saltillo", "culiacán", "mexicali", "norteño"],
    "occidente": ["tapatío", "guadalajara", "jalisco", "colima", "aguascalientes", "guanajuato", "león", "bajío", "occidental"],
    "sureste": ["yucateco", "mérida", "yucatán", "cancún", "quintana roo", "campeche", "península de yucatán", "maya"],
    "sur": ["oaxaca", "chiapas", "guerrero", "tuxtla gutiérrez", "acapulco", "oaxaqueño", "chiapaneco", "zapoteco", "mixteco"],
    "golfo": ["jarocho", "veracruz", "xalapa", "villahermosa", "tabasco", "tampico", "golfo de méxico", "veracruzano"],
}

# ---- Fixed values: quality scores -----------------------------------------------------------------------------------
DIALECT_WORDS = [
    "ahorita", "órale", "güey", "wey", "neta", "chido", "padre", "padrísimo", "gacho", "fresa", "naco", "antro", "cantina", "tianguis",
    "quesadilla", "torta", "bolillo", "chilango", "defeño", "regiomontano", "tapatío", "poblano", "jarocho", "yucateco", "norteño", "sureño",
    "bajacaliforniano", "camote", "elote", "esquite", "jícama", "mamey", "chicozapote", "tepache", "pulque", "atole", "champurrado", "pozole",
    "menudo", "machaca", "carnitas", "barbacoa", "cochinita", "salsita", "picosito", "cuate", "compadre", "comadre", "manito", "carnala",
    "carnalito",
]
DIALECT_PHRASES = [
    "no manches", "qué padre", "está padrísimo", "qué gacho", "de volada", "al chile", "está cañón", "qué pedo", "ni modo", "órale pues",
    "ándale pues", "ahí nos vemos", "qué onda", "cómo estás", "dónde andas", "ahorita vengo", "ya merito", "luego luego", "de perdida",
    "por si las moscas", "dar la vuelta", "echar la hueva", "hacer la lucha", "ponerse trucha", "está de pelos", "está chingón", "vale madre",
    "está dlv", "ni pedo",
]
DIMINUTIVES = ["ahorita", "poquito", "chiquito", "rapidito", "despacito", "cerquita", "lejitos", "tantito", "nadita", "solito", "quietito", "calladito"]
FORMAL_VERY_HIGH = [
    "asimismo", "por tanto", "en consecuencia", "no obstante", "sin embargo", "por consiguiente", "en efecto", "cabe señalar", "es menester",
    "resulta pertinente", "en tal sentido", "dicho esto", "habida cuenta", "a tenor de", "en virtud de", "a la luz de", "dado que", "puesto que",
    "toda vez que", "en tanto que", "por cuanto", "atento a lo anterior", "en este orden de ideas", "de conformidad con", "en cumplimiento de",
]
FORMAL_HIGH = [
    "además", "igualmente", "también", "asimismo", "del mismo modo", "por otra parte", "por un lado", "por otro lado", "en primer lugar",
    "en segundo lugar", "finalmente", "en conclusión", "para concluir", "en resumen", "en síntesis", "dicho de otro modo", "es decir", "esto es",
    "por ejemplo", "tal como", "así como", "de esta manera", "de este modo", "por lo tanto", "así pues", "entonces",
]
FORMAL_MEDIUM = [
    "pero", "aunque", "sin embargo", "mientras", "cuando", "donde", "porque", "ya que", "como", "si", "para que", "con el fin de", "a pesar de",
    "a través de", "mediante", "según", "conforme", "respecto a", "en cuanto a", "en relación con", "acerca de",
]
ACADEMIC_WORDS = [
    "metodología", "análisis", "investigación", "estudio", "evaluación", "diagnóstico", "planteamiento", "hipótesis", "resultados",
    "conclusiones", "recomendaciones", "propuesta", "implementación", "desarrollo", "contextualización", "fundamentación", "conceptualización",
    "sistematización", "caracterización", "identificación", "descripción", "interpretación", "comprensión", "explicación", "justificación",
]
HISTORY = [
    "revolución mexicana", "independencia de méxico", "conquista", "virreinato", "porfiriato", "cristiada", "movimiento estudiantil",
    "dos de octubre", "tlatelolco", "benito juárez", "miguel hidalgo", "josé maría morelos", "emiliano zapata", "pancho villa",
    "francisco madero", "venustiano carranza", "álvaro obregón", "lázaro cárdenas", "sor juana",
]
CULTURE = [
    "día de muertos", "día de los muertos", "posadas", "quinceañera", "grito de independencia", "cinco de mayo", "virgen de guadalupe",
    "mariachi", "jarabe tapatío", "danza folklórica", "lucha libre", "frida kahlo", "diego rivera", "josé clemente orozco",
    "david alfaro siqueiros", "octavio paz", "carlos fuentes", "juan rulfo", "elena poniatowska", "carlos monsiváis", "josé emilio pacheco",
    "jaime sabines",
]
GEOGRAPHY = [
    "valle de méxico", "altiplano", "sierra madre", "golfo de méxico", "mar de cortés", "península de yucatán", "península de baja california",
    "istmo de tehuantepec", "río bravo", "lago de chapala", "popocatépetl", "iztaccíhuatl", "pico de orizaba", "nevado de toluca",
    "cofre de perote",
]
COMPLEX_PATTERNS = [
    r"\b(?:aunque|si bien|aun cuando|a pesar de que|pese a que)\b.*?\b(?:sin embargo|no obstante|empero)\b",
    r"\b(?:no solo|no solamente|no únicamente).*?\bsino (?:que )?también\b",
    r"\b(?:tanto|así como|igual que).*?\bcomo\b",
    r"\b(?:por un lado|por una parte).*?\b(?:por otro|por otra parte)\b",
    r"\b(?:en primer lugar|primeramente).*?\b(?:en segundo lugar|posteriormente|finalmente)\b",
]
SUBORDINATORS = ["que", "porque", "aunque", "cuando", "donde", "como", "si"]

# ---- Fixed values: links --------------------------------------------------------------------------------------------
LINK_KEYWORDS = [
    "méxico", "mexicano", "mexicana", "mx", "cdmx", "guadalajara", "monterrey", "gobierno", "gob", "unam", "ipn", "scjn", "conacyt", "inegi",
    "artículo", "noticia", "investigación", "tesis", "publicación", "cultura", "historia", "política", "economía", "sociedad",
]
ANCHOR_BONUS = {
    "artículo": 3.0, "noticia": 3.0, "investigación": 4.0, "tesis": 5.0, "publicación": 4.0, "documento": 2.0, "política": 2.0, "cultura": 2.0,
    "historia": 2.0, "economía": 2.0, "sociedad": 2.0, "gobierno": 3.0,
}
PLACE_BONUS = {
    "méxico": 4.0, "mexicano": 4.0, "cdmx": 3.0, "guadalajara": 2.0, "monterrey": 2.0, "puebla": 2.0, "tijuana": 2.0, "mérida": 2.0, "nacional": 1.5,
}
SKIP_PATTERNS = [
    "/contact", "/contacto", "/about", "/acerca", "/privacy", "/privacidad", "/terms", "/terminos", "/subscribe", "/suscribir", "/login",
    "/register", "/search", "/buscar", r"\.pdf$", r"\.doc$", r"\.zip$",
]
ARTICLE_PATTERNS = [
    "/articul[eo]s?/", "/noticia[s]?/", "/news/", "/content/", "/post[s]?/", "/entrada[s]?/", "/blog/", "/opinion/", "/editorial/",
    "/reportaje[s]?/", "/cronica[s]?/", "/especial[es]?/", "/investigacion/", "/analisis/", "/columna[s]?/", r"/\d{4}/\d{2}/\d{2}/",
    r"/\d{4}/\d{1,2}/", r"\.html$", r"\.htm$",
]
ARCHIVE_PATTERNS = [
    "/hemeroteca", "/archivo", "/archive", "/historico", "/edicion", "/ediciones", "/portada[s]?", "/anteriores", "/pasadas", "/categoria[s]?/",
    "/seccion[es]?/", "/tag[s]?/", "/tema[s]?/",
]
PRIORITY_HOSTS = [
    "elpais.com", "eluniversal.com.mx", "milenio.com", "proceso.com.mx", "sinembargo.mx", "animalpolitico.com", "nexos.com.mx",
    "letraslibres.com", "jornada.com.mx", "excelsior.com.mx", "reforma.com", "eleconomista.com.mx", "forbes.com.mx", "expansion.mx",
    "vanguardia.com.mx", "heraldo.mx", "grupometropoli.net",
]
EXCLUDE_PATTERNS = [
    "/publicidad", "/anuncio[s]?", "/banner[s]?", "/widget[s]?", "/social", "/share", "/compartir", "/facebook", "/twitter", "/instagram",
    "/youtube", "/linkedin", "/whatsapp", "/telegram", "/rss", "/feed", "/sitemap", r"\.xml$", r"\.json$", r"\.js$", r"\.css$", r"\.jpg$",
    r"\.jpeg$", r"\.png$", r"\.gif$", r"\.pdf$", r"\.doc[x]?$", r"\.xls[x]?$", "/admin", "/login", "/registro", "/suscripc", "/newsletter",
    "/contacto", "/acerca", "/about", "/legal", "/privacidad", "/terminos", "/cookies",
]
HOME_PATHS = ["/", "/index.html", "/index.htm", "/inicio", "/home"]
JS_HOSTS = [
    "reddit.com", "animalpolitico.com", "nexos.com.mx", "letraslibres.com", "milenio.com", "eluniversal.com.mx", "proceso.com.mx", "sinembargo.mx",
    "forbes.com.mx", "expansion.mx",
]
CHALLENGE_PHRASES = ["cloudflare", "checking your browser", "enable javascript", "captcha", "robot verification", "ddos protection"]

# ---- Fixed values: comments and posts -------------------------------------------------------------------------------
SPAM_PATTERNS = ["http[s]?://", r"www\.", r"\.com", "viagra", "casino", "poker", "bitcoin", "cryptocurrency"]
SPANISH_LETTERS = ["ñ", "ü", "á", "é", "í", "ó", "ú"]
COMMENT_WORDS = ["el", "la", "los", "las", "de", "del", "que", "es", "en", "un", "una"]
POST_WORDS = ["que", "pero", "como", "para", "con", "por", "este", "una", "muy"]
TRANSCRIPT_WORDS = ["que", "pero", "como", "para", "con", "por", "este", "una", "muy", "hola", "gracias"]
COMMENT_SELECTORS = [
    ".comment-text", ".comment-content", ".comment-body", ".comentario", ".comentario-texto", ".comentario-contenido", ".reply-text",
    ".reply-content", ".respuesta", ".discussion-text", ".discusion-contenido", ".fb-comment", ".disqus-comment", ".livefyre-comment",
    '[class*="comment"]', '[class*="comentario"]', '[class*="reply"]', '[class*="respuesta"]',
]

# ---- Fixed values: domains ------------------------------------------------------------------------------------------
DOMAIN_TLDS = [".mx", ".com.mx", ".org.mx", ".edu.mx", ".gob.mx", ".net.mx"]
DOMAIN_KEYWORDS = ["mexico", "mexicano", "mx", "cdmx", "guadalajara", "monterrey", "unam", "ipn", "tec", "itesm", "gobierno", "gob"]
NEWS_KEYWORDS = ["noticias", "news", "diario", "periodico", "radio", "tv"]
CRAWL_DEPTH = {"government": 4, "education": 5, "news": 3, "organization": 3, "commercial": 2, "general": 2}
BASE_RECURSION = ["méxico", "mexicano", "artículo", "contenido"]
RECURSION = {
    "government": ["ley", "decreto", "reglamento", "norma", "acuerdo"],
    "education": ["investigación", "tesis", "publicación", "artículo", "revista"],
    "news": ["noticia", "reportaje", "editorial", "opinión", "columna"],
    "organization": ["proyecto", "iniciativa", "programa", "evento"],
    "commercial": ["producto", "servicio", "empresa", "negocio"],
}

# ---- Fixed values: URL priority -------------------------------------------------------------------------------------
PRIORITY_OFFICIAL = [".gob.mx", ".edu.mx", "unam", "ipn"]
PRIORITY_NEWS = ["noticia", "articulo", "2024", "2025"]
PRIORITY_SOCIAL = ["reddit.com", "youtube.com"]
PRIORITY_PLACES = ["mexico", "mexicano", "cdmx", "guadalajara", "monterrey"]

# ---- Fixed values: PDF documents ------------------------------------------------------------------------------------
PDF_ACADEMIC = [
    "resumen", "abstract", "introducción", "metodología", "conclusiones", "referencias", "bibliografía", "universidad", "instituto", "tesis",
    "artículo", "investigación", "estudio", "análisis",
]
PDF_GOVERNMENT = [
    "scjn", "dof", "diputados", "senado", "presidencia", "secretaría", "instituto nacional", "consejo nacional", "comisión nacional",
]
PDF_LEGAL = ["ley", "decreto", "reglamento", "norma"]
PDF_MANUAL = ["manual", "guía", "instructivo"]
PDF_CONNECTORS = [
    "asimismo", "por tanto", "en consecuencia", "no obstante", "sin embargo", "por consiguiente", "en efecto", "cabe señalar", "es menester",
    "resulta pertinente", "en tal sentido",
]

# ---- Fixed values: feeds --------------------------------------------------------------------------------------------
TOPICS = {
    "politica": ["méxico", "mexicano", "amlo", "sheinbaum", "morena", "congreso", "senado", "diputados"],
    "cultura": ["cultura mexicana", "literatura", "arte", "tradición", "patrimonio"],
    "sociedad": ["sociedad mexicana", "comunidad", "familia", "educación"],
    "economia": ["economía mexicana", "peso", "pemex", "banxico"],
    "judicial": ["suprema corte", "scjn", "tribunal", "justicia"],
}

# ---- Fixed values: text validation ----------------------------------------------------------------------------------
SPANISH_CHARS = "áéíóúñüÁÉÍÓÚÑÜ¿¡"
BINARY_PATTERNS = [
    "[£¤¥¦§¨©ª«¬®¯°±²³´µ¶·¸¹º»¼½¾¿]{3,}",
    "[ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ]{15,}",
    "[⁄¡¢£¤¥¦§¨©ª«¬­®¯°±²³´µ¶·¸¹º»¼½¾¿]{3,}",
    "[μÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ]{10,}",
    "[̧̈́̄]{3,}",
    r"\s*[^\x20-\x7E\u00A0-\u00FF\u0100-\u017F\u2000-\u206F]{10,}",
]
PROBLEM_CHARS = "£¤¥¦§¨©ª«¬®¯°±²³´µ¶·¸¹º»¼½¾¿ÀÂÃÄÅÆÇÈÊËÌÎÏÐÒÔÕÖØÙÛÜÝÞßâãäåæçèêëìîïðòôõö÷øùûüýþÿ"
FUNCTION_WORDS = [
    r"\b(el|la|los|las|un|una|de|del|en|con|por|para|que|se|es|son|está|están)\b",
    r"\b(y|o|pero|sino|como|cuando|donde|porque|si|ya|no|sí|muy|más|menos)\b",
    r"\b(tiene|tienen|hacer|hace|ser|estar|ir|va|van|puede|pueden)\b",
]
MOJIBAKE = {"Ã¡": "á", "Ã©": "é", "Ã­": "í", "Ã³": "ó", "Ãº": "ú", "Ã±": "ñ", "Ã¼": "ü", "Â¿": "¿", "Â¡": "¡"}

# ---- Fixed values: site rules ---------------------------------------------------------------------------------------
SITE_RULES: dict[str, dict] = {
    "letras.com": {
        "selectors": ["div.cnt-letra", ".lyric-original", ".letra-l"],
        "remove": [".cnt-tlix", ".banner", ".header", ".footer"],
        "metadata": {"title": ["h1", ".cnt-head_title", ".head-title"], "artist": ["h2 a", ".cnt-head_desc a", ".head-subtitle"], "album": [".letra-info a"], "language": ["[data-language]"]},
    },
    "gob.mx": {
        "selectors": [".article-body", ".contenido-articulo", ".field-item", ".content-area", "article.node", ".contenido"],
        "remove": [".social-share", ".compartir", ".redes-sociales", ".nav-secondary", ".sidebar", ".widget-area"],
        "metadata": {"title": ["h1.title", ".article-title", "h1"], "date": ["time", ".fecha", ".date", "[datetime]"], "author": [".autor", ".author", ".by-author"]},
    },
    "scjn.gob.mx": {
        "selectors": [".publicacion-contenido", ".articulo-texto", ".field-item", ".contenido-principal", ".sentencia-texto", ".jurisprudencia-contenido"],
        "remove": [".menu-lateral", ".barra-herramientas", ".navegacion-secundaria"],
        "metadata": {"title": [".titulo-publicacion", "h1.title", "h1"], "date": [".fecha-publicacion", "time", ".fecha"], "type": [".tipo-documento", ".categoria"]},
    },
    "diputados.gob.mx": {
        "selectors": [".ley-contenido", ".articulo-texto", ".stenographic-version", ".debate-content", ".contenido-principal"],
        "remove": [".menu-navegacion", ".herramientas-laterales"],
        "special": "legislature",
    },
    "cronica.diputados.gob.mx": {
        "selectors": [".debate-content", ".stenographic-version", ".contenido-debate", ".transcripcion"],
        "remove": [".menu-lateral", ".herramientas"],
        "special": "debate_transcript",
    },
    "unam.mx": {
        "selectors": [".article-content", ".contenido-obra", ".field-item", ".contenido-academico", ".texto-completo"],
        "remove": [".menu-lateral", ".sidebar-academic", ".herramientas-repositorio"],
        "metadata": {"title": [".titulo-obra", ".article-title", "h1"], "author": [".autor-obra", ".author", ".investigador"], "institution": [".institucion", ".departamento"]},
    },
    "dof.gob.mx": {
        "selectors": [".documento-contenido", ".nota-contenido", ".contenido-dof", ".texto-oficial"],
        "remove": [".herramientas-dof", ".menu-servicios"],
        "special": "official_gazette",
    },
    "jornada.com.mx": {"selectors": [".texto", ".article-text", ".contenido-nota"], "remove": [".publicidad", ".relacionadas", ".redes"]},
    "eluniversal.com.mx": {"selectors": [".field-item", ".article-body", ".nota-texto"], "remove": [".ads", ".related-news", ".social-bar"]},
    "milenio.com": {"selectors": [".nota-texto", ".article-content", ".contenido-nota"], "remove": [".widget-publicidad", ".notas-relacionadas"]},
}
GAZETTE_REMOVE = [".menu-dof", ".herramientas", ".navegacion"]
GAZETTE_CONTENT = [".documento-contenido", ".contenido-dof", ".texto-oficial", ".contenido-principal"]
LEGISLATURE_REMOVE = [".menu-legislacion", ".herramientas-ley", ".navegacion"]
LEGISLATURE_CONTENT = ".ley-contenido, .articulo-texto, .contenido-principal"
SPEAKER_PATTERNS = [
    r"(?i)^(EL|LA)\s+(PRESIDENTE|PRESIDENTA|SECRETARIO|SECRETARIA|DIPUTADO|DIPUTADA)\s+([^:]+):",
    r"(?i)^([A-ZÁÉÍÓÚÑ\s]+):\s*",
    r"^\s*-\s*([^-]+)\s*-\s*",
]

# ---- Fixed values: cleaning of PDFs, lyrics, gazettes and laws; pattern and what takes its place, in the order of application -------------------
PDF_CLEANING = [
    (r"(?U)\n\s*\n\s*\n", "\n\n"), (r"[ \t]+", " "), (r"(?U)\n\s*\d+\s*\n", "\n"), (r"(?iU)\n\s*Página \d+.*?\n", "\n"), ("[●•▪▫■□]", ""), ("[-_]{3,}", ""),
    (r"(?U)(\w+)-\s*\n\s*(\w+)", "$1$2"),
]
LYRICS_CLEANING = [(r"\[.*?\]", ""), (r"\(.*?\)", ""), (r"(?U)\d{2}:\d{2}", ""), (r"(?U)@\w+", ""), (r"(?U)\s+", " "), (r"(?U)([.!?])(\w)", "$1 $2")]
GAZETTE_LINES = [r"\n\s*Página\s+\d+.*?\n", r"\n\s*DIARIO OFICIAL.*?\n", r"\n\s*\d{1,2}\s+de\s+\w+\s+de\s+\d{4}\s*\n"]
GAZETTE_BLANKS = r"\n\s*\n\s*\n"
LAW_HEADINGS = [(r"\n\s*Artículo\s+(\d+[.-])", "Artículo"), (r"\n\s*Capítulo\s+([IVX]+)", "Capítulo"), (r"\n\s*Título\s+([IVX]+)", "Título")]

# ---- Fixed values: lyrics -------------------------------------------------------------------------------------------
ARTIST_SELECTORS = [
    "a.artist-name", "ul.cnt-list a", ".artista-box a", ".cnt-listaArtistas a", ".lista-letras a", ".top50-pos a", ".cnt-top a",
    'a[href*="/artista/"]', 'a[href*="/artist/"]',
]
SONG_SELECTORS = [
    ".songList-table-songName", "ul.cnt-list li a", ".cnt-letras a", ".song-name", 'a[href*="/cancion/"]', 'a[href*="/traduccion/"]', ".top50-pos a",
    ".artista-todos a", ".artista-top a",
]
SONG_ARTIST_SELECTORS = [
    "div.cnt-head_title div.cnt-head_artistname a", "h2 a", "div.header-section-title h2 a", "div.artist-name", "div.cnt-head h2",
]
LYRICS_SELECTORS = ["div.lyric-original", ".lyric-original", "div.cnt-letra", ".letra", ".lyric"]
LYRICS_UNWANTED = "script, style, .ads, .banner, .pub"
LYRICS_TABS = ["Letra", "Traducción", "Significado"]
NEXT_WORDS = ["próximo", "siguiente", "next", "›"]
FRESH_SELECTORS = ["time[datetime]", '[class*="date"]', '[class*="tiempo"]', '[class*="fecha"]', 'meta[property="article:published_time"]']
CHANNEL_PATTERNS = [
    r"youtube\.com/channel/([a-zA-Z0-9_-]+)", r"youtube\.com/c/([a-zA-Z0-9_-]+)", r"youtube\.com/@([a-zA-Z0-9_-]+)",
    r"youtube\.com/user/([a-zA-Z0-9_-]+)",
]
