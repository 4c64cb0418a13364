"""One run of an untrusted program in a child process with limits."""

from __future__ import annotations

import json
import os
import re
import resource
import shutil
import signal
import subprocess
import sys
import tempfile
from dataclasses import dataclass

from kelpforge.functions.pynorm import compiles

#: Starts the line on which a called function's value is printed.
MARK = "@@kelpforge-value@@"
#: Put before each program: no sockets.
_GUARD = "import socket as _s\ndef _no(*a, **k): raise OSError('network is off')\n_s.socket = _s.create_connection = _s.getaddrinfo = _no\ndel _s, _no\n"
_CALL = """
import json as _kj, sys as _ks
_ka = _kj.loads(_ks.stdin.read())
if not isinstance(_ka, list): raise TypeError("arguments must be a list")
_kn = {name!r}
_kf = globals()[_kn] if _kn in globals() else getattr(globals()["Solution"](), _kn)
print("\\n" + {mark!r} + _kj.dumps(_kf(*_ka), ensure_ascii=False, separators=(",", ":")))
"""


@dataclass(frozen=True)
class Limits:
    """Seconds of a run, MB of memory, bytes of input and of output, and whether bubblewrap
    isolates the run (namespaces of its own, the system read-only)."""

    seconds: float = 3.0
    memory_mb: int = 512
    bytes: int = 65_536
    bubblewrap: bool = False


@dataclass(frozen=True)
class Run:
    """ok, runtime_error, timeout, invalid_input, output_limit or compile_error, with outputs."""

    status: str
    stdout: str = ""
    stderr: str = ""
    exception: str | None = None


def _confine(limits: Limits):
    def apply() -> None:
        os.setsid()
        cpu = int(limits.seconds) + 1
        for kind, value in ((resource.RLIMIT_AS, limits.memory_mb << 20), (resource.RLIMIT_CPU, cpu), (resource.RLIMIT_NOFILE, 64), (resource.RLIMIT_CORE, 0), (resource.RLIMIT_FSIZE, 16 << 20)):
            resource.setrlimit(kind, (value, value))

    return apply


def command(script: str, folder: str, limits: Limits = Limits()) -> list[str]:
    """The command of a run: Python alone, or inside bubblewrap without a network, with nothing
    but the run's own folder to write to. A worker without bubblewrap is an error, never a run
    without isolation."""
    python = [sys.executable, "-I", "-S", script]
    if not limits.bubblewrap:
        return python
    tool = shutil.which("bwrap")
    if tool is None:
        raise RuntimeError("bubblewrap isn't installed on this worker")
    system = [p for p in dict.fromkeys(("/usr", "/bin", "/lib", "/lib64", sys.prefix, sys.base_prefix)) if os.path.exists(p)]
    shown = [x for p in system for x in ("--ro-bind", p, p)]
    return [tool, "--unshare-all", "--die-with-parent", "--new-session", "--proc", "/proc", "--dev", "/dev", *shown, "--bind", folder, folder, "--chdir", folder, *python]


def run(code: str, stdin: str, limits: Limits = Limits()) -> Run:
    """Runs a program on an input. Failures are statuses, never exceptions, so a retried task
    gives the same row."""
    if len(stdin.encode()) > limits.bytes:
        return Run("invalid_input")
    if not compiles(code):
        return Run("compile_error")
    with tempfile.TemporaryDirectory() as folder:
        script = os.path.join(folder, "main.py")
        with open(script, "w", encoding="utf-8") as f:
            f.write(_GUARD + code)
        out, err = open(os.path.join(folder, "out"), "w+b"), open(os.path.join(folder, "err"), "w+b")
        with out, err:
            env = {"PATH": "/usr/bin:/bin", "HOME": folder, "PYTHONIOENCODING": "utf-8", "PYTHONHASHSEED": "0"}
            child = subprocess.Popen(command(script, folder, limits), stdin=subprocess.PIPE, stdout=out, stderr=err, cwd=folder, env=env, preexec_fn=_confine(limits))
            try:
                child.communicate(stdin.encode(), timeout=limits.seconds)
                late = False
            except subprocess.TimeoutExpired:
                late = True
            except BrokenPipeError:
                child.wait()
                late = False
            finally:
                try:
                    os.killpg(child.pid, signal.SIGKILL)
                except (ProcessLookupError, PermissionError):
                    pass
                child.wait()
            out.seek(0)
            err.seek(0)
            shown, said = out.read(limits.bytes + 1), err.read(limits.bytes).decode("utf-8", "replace")
    text = shown[: limits.bytes].decode("utf-8", "replace")
    if late or child.returncode == -signal.SIGXCPU:
        return Run("timeout", text, said)
    if len(shown) > limits.bytes:
        return Run("output_limit", text, said)
    if child.returncode:
        name = re.findall(r"^(\w+(?:\.\w+)*)(?::|$)", said, re.M)
        return Run("runtime_error", text, said, name[-1] if name else None)
    return Run("ok", text, said)


def run_candidate(code: str, given: str, mode: str, fn_name: str | None, limits: Limits = Limits()) -> tuple[Run, object]:
    """(run, value): a program on stdin, or a function (or method of ``Solution``) on arguments."""
    if mode != "call":
        got = run(code, given, limits)
        return got, got.stdout
    if not fn_name or not fn_name.isidentifier() or not compiles(code):
        return Run("compile_error" if fn_name and fn_name.isidentifier() else "invalid_input"), None
    got = run(code + _CALL.format(name=fn_name, mark=MARK), given, limits)
    if got.status != "ok":
        return got, None
    marked = [x for x in got.stdout.split("\n") if x.startswith(MARK)]
    if len(marked) != 1:
        return Run("runtime_error", got.stdout, got.stderr, "ResultMissing"), None
    rest = [x for x in got.stdout.split("\n") if not x.startswith(MARK)]
    return Run("ok", "\n".join(rest).strip("\n"), got.stderr), json.loads(marked[0][len(MARK) :])
