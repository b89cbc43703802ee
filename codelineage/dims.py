"""Lookup tables with a fixed number of rows, all small enough to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# File extension -> language.
LANGUAGES = {
    ".py": "python", ".pyx": "cython", ".pxd": "cython", ".cpp": "cpp", ".cc": "cpp", ".cxx": "cpp",
    ".c": "c", ".h": "c", ".hpp": "cpp", ".hxx": "cpp", ".cu": "cuda", ".cuh": "cuda",
    ".java": "java", ".js": "javascript", ".jsx": "javascript", ".ts": "typescript",
    ".tsx": "typescript", ".go": "go", ".rs": "rust", ".rb": "ruby", ".php": "php",
    ".swift": "swift", ".kt": "kotlin", ".scala": "scala", ".r": "r", ".jl": "julia",
    ".lua": "lua", ".sh": "bash", ".bash": "bash", ".zsh": "zsh", ".fish": "fish",
    ".ps1": "powershell", ".yaml": "yaml", ".yml": "yaml", ".json": "json", ".toml": "toml",
    ".ini": "ini", ".cfg": "ini", ".md": "markdown", ".rst": "rst", ".txt": "text", ".sql": "sql",
    ".proto": "protobuf", ".cmake": "cmake", ".make": "makefile", ".dockerfile": "dockerfile",
}

# Extensions whose files become stubs, by the kind named in the stub.
BINARY_KINDS = {
    "IMAGE": [".png", ".jpg", ".jpeg", ".gif", ".bmp", ".ico", ".webp", ".svg", ".tiff", ".tif"],
    "AUDIO": [".mp3", ".wav", ".ogg", ".flac", ".aac", ".m4a", ".wma"],
    "VIDEO": [".mp4", ".avi", ".mov", ".mkv", ".webm", ".wmv", ".flv", ".m4v"],
    "DOCUMENT": [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx"],
    "ARCHIVE": [".zip", ".tar", ".gz", ".bz2", ".xz", ".7z", ".rar", ".tgz"],
    "PACKAGE": [".whl", ".egg"],
    "COMPILED": [".so", ".dll", ".dylib", ".exe", ".bin", ".o", ".a"],
    "MODEL/DATA": [".pkl", ".pickle", ".npy", ".npz", ".pt", ".pth", ".onnx", ".safetensors", ".gguf"],
    "FONT": [".ttf", ".otf", ".woff", ".woff2", ".eot"],
    "FILE": [".lib", ".ggml", ".model", ".parquet", ".arrow", ".feather", ".h5", ".hdf5", ".pyc", ".pyo", ".class", ".jar", ".war"],
}

# Package -> repository; the order is the priority.
KNOWN_PACKAGES = {
    "torch": "pytorch/pytorch",
    "pytorch": "pytorch/pytorch",
    "tensorflow": "tensorflow/tensorflow",
    "jax": "google/jax",
    "flax": "google/flax",
    "numpy": "numpy/numpy",
    "scipy": "scipy/scipy",
    "pandas": "pandas-dev/pandas",
    "scikit-learn": "scikit-learn/scikit-learn",
    "sklearn": "scikit-learn/scikit-learn",
    "transformers": "huggingface/transformers",
    "datasets": "huggingface/datasets",
    "accelerate": "huggingface/accelerate",
    "peft": "huggingface/peft",
    "trl": "huggingface/trl",
    "diffusers": "huggingface/diffusers",
    "tokenizers": "huggingface/tokenizers",
    "safetensors": "huggingface/safetensors",
    "vllm": "vllm-project/vllm",
    "triton": "openai/triton",
    "flash-attn": "Dao-AILab/flash-attention",
    "flash_attn": "Dao-AILab/flash-attention",
    "xformers": "facebookresearch/xformers",
    "fairscale": "facebookresearch/fairscale",
    "deepspeed": "microsoft/DeepSpeed",
    "megatron": "NVIDIA/Megatron-LM",
    "apex": "NVIDIA/apex",
    "tensorrt": "NVIDIA/TensorRT",
    "onnx": "onnx/onnx",
    "onnxruntime": "microsoft/onnxruntime",
    "langchain": "langchain-ai/langchain",
    "llama-index": "run-llama/llama_index",
    "mlflow": "mlflow/mlflow",
    "ray": "ray-project/ray",
    "dask": "dask/dask",
    "wandb": "wandb/wandb",
    "optuna": "optuna/optuna",
    "hydra-core": "facebookresearch/hydra",
    "lightning": "Lightning-AI/pytorch-lightning",
    "pytorch-lightning": "Lightning-AI/pytorch-lightning",
    "einops": "arogozhnikov/einops",
    "sentencepiece": "google/sentencepiece",
    "tiktoken": "openai/tiktoken",
    "bitsandbytes": "TimDettmers/bitsandbytes",
}

# Topics searched by default, in order.
DEFAULT_TOPICS = [
    "large-language-models", "llm", "transformers", "deep-learning", "machine-learning", "pytorch",
    "tensorflow", "nlp", "natural-language-processing", "computer-vision", "generative-ai",
    "diffusion-models", "reinforcement-learning", "mlops", "model-serving", "inference",
    "quantization", "fine-tuning", "rag", "vector-database", "embeddings",
]

# Hand-picked repositories, in order.
CURATED_REPOS = [
    "pytorch/pytorch", "tensorflow/tensorflow", "google/jax", "apple/mlx",
    "huggingface/transformers", "huggingface/diffusers", "huggingface/accelerate",
    "huggingface/peft", "huggingface/trl", "huggingface/datasets", "huggingface/tokenizers",
    "huggingface/safetensors",
    "vllm-project/vllm", "NVIDIA/TensorRT-LLM", "ggerganov/llama.cpp", "ggerganov/whisper.cpp",
    "mlc-ai/mlc-llm", "xorbitsai/inference",
    "hiyouga/LLaMA-Factory", "OpenAccess-AI-Collective/axolotl", "Lightning-AI/pytorch-lightning",
    "microsoft/DeepSpeed", "facebookresearch/fairscale",
    "langchain-ai/langchain", "run-llama/llama_index", "BerriAI/litellm", "guidance-ai/guidance",
    "outlines-dev/outlines",
    "openai/triton", "NVIDIA/cutlass", "Dao-AILab/flash-attention", "facebookresearch/xformers",
    "mlflow/mlflow", "ray-project/ray", "wandb/wandb", "bentoml/BentoML",
    "meta-llama/llama", "meta-llama/llama-models", "mistralai/mistral-src", "QwenLM/Qwen",
    "THUDM/ChatGLM-6B", "lm-sys/FastChat",
    "microsoft/autogen", "Significant-Gravitas/AutoGPT", "geekan/MetaGPT",
    "EleutherAI/lm-evaluation-harness", "openai/evals",
]

# Categories of the curated listing; None stands for the name rule below.
CURATED_CATEGORIES = {
    "Core ML Frameworks": ["pytorch/pytorch", "tensorflow/tensorflow", "google/jax", "apple/mlx"],
    "HuggingFace Ecosystem": None,
    "Inference Engines": [
        "vllm-project/vllm", "NVIDIA/TensorRT-LLM", "ggerganov/llama.cpp", "mlc-ai/mlc-llm",
    ],
    "LLM Frameworks": ["langchain-ai/langchain", "run-llama/llama_index", "BerriAI/litellm"],
    "Training & Fine-tuning": [
        "hiyouga/LLaMA-Factory", "OpenAccess-AI-Collective/axolotl", "microsoft/DeepSpeed",
    ],
}
CURATED_NAME_RULE = "huggingface"


def inline_table(spark: SparkSession, rows, columns: list[str]) -> DataFrame:
    """A literal table inside the plan (no job, no Python data source)."""
    def literal(value):
        if value is None:
            return "NULL"
        if isinstance(value, int):
            return str(value)
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def languages(spark: SparkSession) -> DataFrame:
    return inline_table(spark, LANGUAGES.items(), ["ext", "language"])


def binary_types(spark: SparkSession, extra_extensions: list[str] | None = None) -> DataFrame:
    """Extension -> kind. ``extra_extensions`` replaces the set of stubbed extensions."""
    kinds = {ext: kind for kind, exts in BINARY_KINDS.items() for ext in exts}
    if extra_extensions is not None:
        kinds = {ext: kinds.get(ext, "FILE") for ext in map(str.lower, extra_extensions)}
    return inline_table(spark, kinds.items(), ["ext", "kind"])


def known_packages(spark: SparkSession) -> DataFrame:
    rows = [(package, repo, rank) for rank, (package, repo) in enumerate(KNOWN_PACKAGES.items())]
    return inline_table(spark, rows, ["package", "github_repo", "priority"])


def topics(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    return inline_table(spark, [(t, i) for i, t in enumerate(names or DEFAULT_TOPICS)], ["topic", "topic_rank"])


def curated(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    return inline_table(spark, [(n, i) for i, n in enumerate(names or CURATED_REPOS)], ["name", "curated_rank"])


def curated_categories(spark: SparkSession) -> DataFrame:
    """Category lists with positions; the rule-based category is taken from the curated names."""
    rows = []
    for rank, (category, names) in enumerate(CURATED_CATEGORIES.items()):
        listed = names or [n for n in CURATED_REPOS if CURATED_NAME_RULE in n]
        rows += [(rank, category, place, name) for place, name in enumerate(listed)]
    return inline_table(spark, rows, ["category_rank", "category", "place", "name"])
