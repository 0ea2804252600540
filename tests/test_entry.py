import builtins
import sys

import __spark_entry__
from tableferry.registry.queries import QUERIES


def test_library_queries_stay_without_what_the_others_need(monkeypatch):
    """Whatever cannot be imported there: a library, or the subpackage itself."""
    real = builtins.__import__
    for hidden in ("tokenizers", "ahocorasick", "corpus_pipeline", "tableferry.llm.queries"):

        def refuse(name, *args, hidden=hidden, **more):
            if name == hidden or name.startswith(f"{hidden}."):
                raise ImportError(name)
            return real(name, *args, **more)

        with monkeypatch.context() as patch:
            for name in [n for n in sys.modules if n.startswith(("tableferry.llm", "corpus_pipeline", hidden))]:
                patch.delitem(sys.modules, name)
            patch.setattr(builtins, "__import__", refuse)
            assert __spark_entry__.queries() == QUERIES
            assert set(__spark_entry__.oracle_sql()) <= set(QUERIES)
