"""Dimension tables of the trajectory engine: tools, intents, locales, messages, templates, dataset configs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

# Tools in registry order with category, draw weight, error cause and arguments
# (name, type, required); names are part of the record format.
TOOLS = [
    ("Bash", "bash", 1.2, "command not found", [("command", "string", True), ("timeout", "integer", False), ("working_directory", "string", False)]),
    ("File_Read", "file", 1.5, "file not found", [("file_path", "string", True), ("offset", "integer", False), ("limit", "integer", False)]),
    ("File_Write", "file", 1.0, "permission denied", [("file_path", "string", True), ("content", "string", True), ("append", "boolean", False)]),
    ("File_Edit", "file", 1.2, "file not found or old_string not matched", [("file_path", "string", True), ("old_string", "string", True), ("new_string", "string", True)]),
    ("Glob", "file", 1.0, "path not found", [("pattern", "string", True), ("path", "string", False)]),
    ("Grep", "search", 1.0, "no matches found", [("pattern", "string", True), ("path", "string", False), ("file_types", "string", False), ("case_sensitive", "boolean", False)]),
    ("TodoWrite", "task", 0.4, "invalid todo format", [("todo", "string", True), ("status", "string", False)]),
    ("TodoRead", "task", 0.4, "todo list not found", []),
    ("Web_Search", "web", 0.8, "network error", [("query", "string", True), ("num_results", "integer", False)]),
    ("Web_Fetch", "web", 0.6, "connection timeout", [("url", "string", True), ("prompt", "string", False)]),
]
TOOL_NAMES = [t[0] for t in TOOLS]

# Default values of arguments and the values that one of them names.
DEFAULTS = {
    ("Bash", "timeout"): 30,
    ("File_Read", "offset"): 0,
    ("File_Write", "append"): False,
    ("Glob", "path"): ".",
    ("Grep", "path"): ".",
    ("Grep", "case_sensitive"): True,
    ("TodoWrite", "status"): "pending",
    ("Web_Search", "num_results"): 5,
}

#: What the prompt and the function schemas say of each tool and of each argument, in our own words.
DESCRIPTIONS = {
    "Bash": "runs one shell command and reports its streams",
    "File_Read": "shows a file, or some lines of it",
    "File_Write": "creates a file, or puts new text in place of the old",
    "File_Edit": "swaps one exact piece of a file for another",
    "Glob": "lists paths that fit a wildcard pattern",
    "Grep": "lists lines that fit a regular expression",
    "TodoWrite": "adds an open task or changes its state",
    "TodoRead": "lists the open tasks",
    "Web_Search": "looks words up on the web",
    "Web_Fetch": "loads one page",
}
ARGUMENT_DESCRIPTIONS = {
    "command": "what the shell is to run",
    "timeout": "seconds until it is stopped",
    "working_directory": "folder to run it in",
    "file_path": "where the file is",
    "offset": "first line to show",
    "limit": "lines to show at most",
    "content": "the new text",
    "append": "whether the old text stays in front",
    "old_string": "the piece to swap out",
    "new_string": "the piece to put there",
    "pattern": "what must fit",
    "path": "folder to look in",
    "file_types": "kinds of files to look at",
    "case_sensitive": "whether capitals matter",
    "todo": "the task in words",
    "status": "how far it is",
    "query": "the words to look up",
    "num_results": "results to give at most",
    "url": "the page's address",
    "prompt": "what to take from the page",
}

# Difficulty shares; locales in order.
DIFFICULTIES = [("easy", 0.30), ("medium", 0.40), ("hard", 0.20), ("expert", 0.10)]
TONES = ["professional", "casual", "technical", "friendly"]
FORMALITIES = ["formal", "neutral", "informal"]
LOCALES = [
    ("en", "professional", "formal"),
    ("en", "professional", "neutral"),
    ("en", "professional", "informal"),
    ("en", "casual", "formal"),
    ("en", "casual", "neutral"),
    ("en", "casual", "informal"),
    ("en", "technical", "formal"),
    ("en", "technical", "neutral"),
    ("en", "technical", "informal"),
    ("en", "friendly", "formal"),
    ("en", "friendly", "neutral"),
    ("en", "friendly", "informal"),
    ("hi", "professional", "formal"),
    ("hi", "professional", "neutral"),
    ("hi", "casual", "neutral"),
    ("hi", "casual", "informal"),
    ("hi", "friendly", "formal"),
    ("hi", "friendly", "neutral"),
    ("es", "professional", "neutral"),
    ("es", "casual", "informal"),
    ("fr", "professional", "formal"),
    ("fr", "casual", "neutral"),
    ("de", "professional", "neutral"),
    ("de", "casual", "informal"),
    ("ja", "professional", "formal"),
    ("ja", "casual", "neutral"),
    ("zh", "professional", "neutral"),
    ("zh", "casual", "informal"),
    ("ko", "professional", "formal"),
    ("ko", "casual", "neutral"),
    ("pt", "professional", "neutral"),
    ("pt", "casual", "informal"),
    ("it", "professional", "neutral"),
    ("it", "casual", "informal"),
    ("ar", "professional", "formal"),
    ("ar", "casual", "informal"),
    ("ru", "professional", "neutral"),
    ("ru", "casual", "informal"),
]
LANGUAGES = list(dict.fromkeys(lang for lang, _, _ in LOCALES))
#: The library entry draws each axis by itself, from these languages.
LIBRARY_LANGUAGES = ["en", "hi", "es", "fr", "de", "ja", "zh"]

# Name, seed, rows, languages, tones and formalities of the ten review datasets.
CONFIGS = [
    ("ds1_english_pro", 1001, 1000, ["en"], ["professional"], ["formal", "neutral"]),
    ("ds2_multilang_casual", 1002, 1000, ["en", "hi", "es", "fr", "de"], ["casual"], ["neutral", "informal"]),
    ("ds3_asian_langs", 1003, 1000, ["ja", "ko", "zh"], ["professional", "friendly"], ["formal", "neutral"]),
    ("ds4_tech_friendly", 1004, 1000, ["en"], ["technical", "friendly"], ["neutral"]),
    ("ds5_eu_languages", 1005, 1000, ["fr", "de", "it", "es", "pt"], ["professional", "casual"], FORMALITIES),
    ("ds6_hindi_hinglish", 1006, 1000, ["hi"], ["casual", "friendly"], ["informal", "neutral"]),
    ("ds7_easy_simple", 1007, 1000, ["en", "es", "fr"], ["friendly", "casual"], ["neutral"]),
    ("ds8_hard_expert", 1008, 1000, ["en"], ["technical", "professional"], ["formal"]),
    ("ds9_all_langs", 1009, 1000, LANGUAGES, TONES, FORMALITIES),
    ("ds10_balanced", 2010, 1000, LIBRARY_LANGUAGES, ["professional", "casual"], FORMALITIES),
]

# The simulator's ordered rules, first match wins; all words of a rule's clause must occur, any clause will do.
BASH_RULES = [
    ("git_status", [["git status"]]), ("git_log", [["git log"]]), ("git_diff", [["git diff"]]), ("git_remote", [["git push"], ["git pull"]]),
    ("npm_install", [["npm install"]]), ("npm_build", [["npm run build"]]), ("npm_test", [["npm test"]]), ("pytest", [["pytest"]]),
    ("cargo_build", [["cargo build"]]), ("cargo_run", [["cargo run"]]), ("docker_ps", [["docker ps"]]), ("find_py", [["find", ".py"]]),
    ("grep", [["grep"], ["rg "]]), ("pip_install", [["pip install"]]), ("python", [["python"]]), ("node", [["node"]]), ("ls", [["ls"]]),
    ("df", [["df -h"]]), ("free", [["free -m"]]), ("ps", [["ps aux"]]), ("wc", [["wc -l"]]),
]

_TOPICS = ["parser", "cache", "queue", "index", "login", "schema", "metrics", "layout", "retry", "export", "search", "billing", "upload", "theme", "router"]
#: Commands of our own: one for each way to meet a rule, about some topic, and some that meet none.
_COMMANDS = [f"{' '.join(w.strip() for w in words)} {_TOPICS[i % len(_TOPICS)]}" for i, words in enumerate(words for _, clauses in BASH_RULES for words in clauses)] + [
    "date -u", "env", "hostname", "tree -L 2", "stat notes.txt", "sort -u words.txt", "cut -f1 table.tsv", "sha256sum app.bin", "tar tf old.tar", "diff -r one two", "mkdir -p out/logs", "touch marker", "printenv PATH", "seq 3",
]


def _intents() -> list[tuple[str, int, str, str]]:
    made: dict[str, list[tuple[str, dict]]] = {
        "Bash": [(f"run {c.split()[0]} ({i})", {"command": c, "timeout": 10 * (1 + i % 3)}) for i, c in enumerate(_COMMANDS)],
        "Grep": [(f"look for {t} in the sources", {"pattern": t, "path": "src"} if i % 2 else {"pattern": t}) for i, t in enumerate(_TOPICS[:12])],
        "TodoWrite": [(f"note work on {t}", {"todo": f"finish {t}", "status": ["pending", "in_progress", "completed"][i % 3]}) for i, t in enumerate(_TOPICS[:6])],
        "TodoRead": [(f"list open work, view {i}", {}) for i in range(1, 6)],
        "Glob": [(f"which files belong to {t}", {"pattern": f"**/{t}*"}) for t in _TOPICS],
        "Web_Search": [(f"read up on {t} design", {"query": f"{t} design", "num_results": 3 + i % 5}) for i, t in enumerate(_TOPICS)],
        "Web_Fetch": [(f"open the {t} page", {"url": f"https://example.org/{t}"}) for t in _TOPICS[:10]],
        # keyed by names that no tool has: only repair_intents reaches them
        "Read": [(f"show {t} part {i}", {"file_path": f"src/{t}.py", "limit": 20 + i} if i else {"file_path": f"src/{t}.py"}) for i in range(2) for t in _TOPICS[: 13 - i]],
        "Write": [(f"save a {t} file", {"file_path": f"out/{t}.txt", "content": f"{t}\nready\n", "append": bool(i % 2)}) for i, t in enumerate(_TOPICS[:12])],
        "Edit": [(f"rename {t}", {"file_path": f"src/{t}.py", "old_string": t if i else "", "new_string": f"{t}_v2"}) for i, t in enumerate(_TOPICS)],
    }
    return [(tool, i, q, json.dumps(a, ensure_ascii=False, separators=(",", ":"))) for tool, rows in made.items() for i, (q, a) in enumerate(rows)]


INTENTS = _intents()
REPAIRED = {"Read": "File_Read", "Write": "File_Write", "Edit": "File_Edit"}

def _library_intents() -> list[tuple[str, int, str, str]]:
    """The library entry's own 73 intents, of five tools; the others get `use <tool>`."""
    made: dict[str, list[tuple[str, dict]]] = {
        "Bash": [(f"shell step {i}: {c}", {"command": c, "timeout": 20}) for i, c in enumerate(_COMMANDS[:32])],
        "File_Read": [(f"print the {t} module", {"file_path": f"lib/{t}.py"}) for t in _TOPICS],
        "File_Write": [(f"store notes on {t}", {"file_path": f"notes/{t}.md", "content": f"# {t}\n"}) for t in _TOPICS[:8]],
        "Web_Search": [(f"compare ways to do {t}", {"query": f"{t} comparison"}) for t in _TOPICS[:10]],
        "Web_Fetch": [(f"get the {t} manual", {"url": f"https://example.org/manual/{t}"}) for t in _TOPICS[:8]],
    }
    return [(tool, i, q, json.dumps(a, ensure_ascii=False, separators=(",", ":"))) for tool, rows in made.items() for i, (q, a) in enumerate(rows)]


LIBRARY_INTENTS = _library_intents()

#: Closing sentences of our own, by difficulty and language (and number, where there are several); what follows a failure's colon is its text.
#: A language without sentences of its own gets the English ones, a difficulty without any those for easy.
SUCCESS_TEXTS = {
    "easy": {"en": ["That worked.", "There you go."], "hi": ["Ho chuka.", "Bas ho gaya kaam."], "es": ["Ya funciona."], "fr": ["C'est bon."], "de": ["Das klappt."], "ja": ["Dekimashita."], "zh": ["Zuo hao le."], "ko": ["Doetseumnida."], "ar": ["Intaha."], "ru": ["Poluchilos."], "pt": ["Deu certo."], "it": ["Tutto bene."]},
    "medium": {"en": ["The work is complete.", "That is finished."], "hi": ["Kaam ho chuka hai."], "es": ["El trabajo ha terminado."], "fr": ["Le travail est fini."], "de": ["Die Arbeit ist beendet."], "ja": ["Sagyou ga owarimashita."], "zh": ["Gongzuo yi wancheng."], "ko": ["Jageobi kkeutnatseumnida."], "ar": ["Intaha al-amal."], "ru": ["Rabota zakonchena."], "pt": ["O trabalho terminou."], "it": ["Il lavoro e finito."]},
    "hard": {"en": ["Every step of it is through."], "hi": ["Har kadam poora hai."], "es": ["Todos los pasos estan listos."], "fr": ["Chaque etape est passee."], "de": ["Alle Schritte sind getan."], "ja": ["Subete no dankai ga owarimashita."], "zh": ["Mei yi bu dou wancheng le."], "ko": ["Modeun dangyega kkeutnatseumnida."], "ar": ["Kull al-khatawat tammat."], "ru": ["Vse shagi proydeny."], "pt": ["Todos os passos passaram."], "it": ["Ogni passo e fatto."]},
}
ERROR_TEXTS = {"en": ["It did not work: ", "This went wrong: "], "hi": ["Yeh nahi hua: "], "es": ["No funciono: "], "fr": ["Cela a echoue : "], "de": ["Es ging nicht: "], "ja": ["Shippai shimashita: "], "zh": ["Shibai le: "], "ko": ["Silpaehaetseumnida: "], "ar": ["Fashila: "], "ru": ["Ne poluchilos: "], "pt": ["Nao funcionou: "], "it": ["Non ha funzionato: "]}
MESSAGES = [("success", d, lang, i, text) for d, texts in SUCCESS_TEXTS.items() for lang, variants in texts.items() for i, text in enumerate(variants)] + [("error", d, lang, i, text) for d in SUCCESS_TEXTS for lang, variants in ERROR_TEXTS.items() for i, text in enumerate(variants)]


def tools(spark: SparkSession) -> DataFrame:
    """The registry, a row a tool; an argument's default is its JSON."""
    rows = [(i, name, category, weight, cause, DESCRIPTIONS[name], [(a, t, r, ARGUMENT_DESCRIPTIONS[a], json.dumps(DEFAULTS[name, a]) if (name, a) in DEFAULTS else None) for a, t, r in arguments]) for i, (name, category, weight, cause, arguments) in enumerate(TOOLS)]
    return spark.createDataFrame(rows, "pos int, tool_name string, category string, weight double, cause string, description string, arguments array<struct<name:string,type:string,required:boolean,description:string,default:string>>")


def intents(spark: SparkSession, repair: bool = False, library: bool = False) -> DataFrame:
    rows = [(REPAIRED.get(t, t) if repair else t, i, q, a) for t, i, q, a in (LIBRARY_INTENTS if library else INTENTS)]
    return spark.createDataFrame(rows, "tool_name string, idx int, query string, arguments string")


def locales(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *row) for i, row in enumerate(LOCALES)], "pos int, language string, tone string, formality string")


def messages(spark: SparkSession) -> DataFrame:
    """kind, difficulty, language, idx, text of the closing sentences."""
    return spark.createDataFrame(MESSAGES, "kind string, difficulty string, language string, idx int, text string")


def configs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONFIGS, "dataset string, seed long, rows long, languages array<string>, tones array<string>, formalities array<string>")
