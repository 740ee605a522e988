"""A provider asked through a ledger: once per prompt, over restarts and failures."""

import collections
import os

import pytest

from comparo.operators.provider_ledger import ask_once, read_ledger
from comparo.session import shared_path

TEMPLATE = "Describe {domain_name}"


def provider(folder, fails=(), killer=None):
    """Answers in capitals and notes every prompt in a file of its own process."""
    class Killed(BaseException):
        """Not the provider's error: the worker dies."""

    def load():
        def answer(prompts):
            with open(f"{folder}/{os.getpid()}", "a") as f:
                f.writelines(p + "\n" for p in prompts)
            if killer and any(killer in p for p in prompts):
                raise Killed()
            if any(x in p for x in fails for p in prompts):
                raise RuntimeError("overloaded")
            return [None if "silent" in p else p.upper() for p in prompts]
        return answer
    return load


def asked(folder):
    return collections.Counter(line.rstrip("\n") for f in os.listdir(folder) for line in open(f"{folder}/{f}"))


@pytest.fixture
def ledger(spark):
    return shared_path(spark, "ledger")


def domains(spark, names):
    return spark.createDataFrame([(n,) for n in names], "domain string")


def test_each_domain_is_asked_once_over_repeats_and_runs(spark, ledger, tmp_path):
    names = [f"d{i % 40}.com" for i in range(200)] + [None]
    got = ask_once(domains(spark, names), provider(tmp_path), TEMPLATE, ledger, batch_rows=10, call_rows=4).collect()
    assert sorted((r.domain, r.response, r.attempts, r.error) for r in got) == sorted(
        (f"d{i}.com", f"DESCRIBE D{i}.COM", 1, None) for i in range(40))
    more = ask_once(domains(spark, ["d1.com", "new.com"]), provider(tmp_path), TEMPLATE, ledger).collect()
    assert sorted(r.response for r in more) == ["DESCRIBE D1.COM", "DESCRIBE NEW.COM"]
    assert set(asked(tmp_path).values()) == {1} and len(asked(tmp_path)) == 41
    ask_once(domains(spark, ["d1.com"]), provider(tmp_path), TEMPLATE, ledger, provider="other")
    assert asked(tmp_path)["Describe d1.com"] == 2  # another provider's answer is another answer


def test_a_killed_run_goes_on_where_it_stopped(spark, ledger, tmp_path):
    names = domains(spark, [f"d{i}.com" for i in range(60)])
    with pytest.raises(Exception):
        ask_once(names, provider(tmp_path, killer="d17."), TEMPLATE, ledger, batch_rows=6, call_rows=3)
    done = {r.prompt_hash for r in read_ledger(spark, ledger).collect()}
    assert len(done) < 60
    before = asked(tmp_path)
    got = ask_once(names, provider(tmp_path), TEMPLATE, ledger, batch_rows=6, call_rows=3).collect()
    assert sorted(r.response for r in got) == sorted(f"DESCRIBE D{i}.COM" for i in range(60))
    again = [p for p, n in asked(tmp_path).items() if n > 1]
    assert len(again) == len(before) - len(done) and len(again) <= 30  # only those of the batch that was lost


def test_failures_are_stored_and_tried_a_bounded_number_of_times(spark, ledger, tmp_path):
    names = domains(spark, ["good.com", "bad.com", "silent.com"])
    for _ in range(2):
        got = {r.domain: r for r in ask_once(names, provider(tmp_path, fails=["bad"]), TEMPLATE, ledger, max_attempts=3,
                                             call_rows=1).collect()}
        assert (got["good.com"].response, got["good.com"].attempts, got["good.com"].error) == ("DESCRIBE GOOD.COM", 1, None)
        assert (got["bad.com"].response, got["bad.com"].attempts, got["bad.com"].error) == (None, 3, "RuntimeError: overloaded")
        assert (got["silent.com"].attempts, got["silent.com"].error) == (3, "no answer")
    assert asked(tmp_path) == {"Describe good.com": 1, "Describe bad.com": 3, "Describe silent.com": 3}
    healed = ask_once(names, provider(tmp_path), TEMPLATE, ledger, max_attempts=4, call_rows=1).collect()
    assert {r.domain: r.response for r in healed} == {"good.com": "DESCRIBE GOOD.COM", "bad.com": "DESCRIBE BAD.COM",
                                                      "silent.com": None}


def test_nothing_to_ask(spark, ledger, tmp_path):
    assert ask_once(domains(spark, []), provider(tmp_path), TEMPLATE, ledger).count() == 0
    assert not os.listdir(tmp_path)
