"""``python -m eventide``: list the registered queries and the runnable jobs."""

from eventide.plans import catalog, run


def main() -> None:
    print("registered queries (plans/catalog.py):")
    for name in catalog.QUERIES:
        print(f"  {name}")
    print("jobs (python -m eventide.plans.run <job> ...):")
    for name, fn in run.JOBS.items():
        doc = (fn.__doc__ or "").strip().splitlines()
        print(f"  {name:6s} {doc[0] if doc else ''}")


if __name__ == "__main__":
    main()
