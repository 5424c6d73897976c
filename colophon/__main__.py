"""Command line: ``python -m colophon <command> ...`` or the same through spark-submit."""

from __future__ import annotations

import argparse

from colophon.operators import authors, components
from colophon.plans import graph, ingest, lookup
from colophon.session import close_scratch, get_session
from colophon.sources import tables as table_io


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="colophon", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name, text, *arguments):
        sub = commands.add_parser(name, help=text)
        for argument, options in arguments:
            sub.add_argument(argument, **options)

    folder = ("folder", {"help": "folder of the tables"})
    out = ("--out", {"help": "write the result as CSV here instead of printing all of it"})
    command("profile", "count elements of an XML dump", ("xml", {"nargs": "+"}), out)
    command("ingest", "shred an XML dump into tables", folder, ("xml", {"nargs": "+"}),
            ("--strict", {"action": "store_true"}),
            ("--known", {"help": "folder of earlier tables whose ids stay"}))
    command("load-csv", "load CSV tables", folder, ("csv", {"help": "folder of <table>.csv"}),
            ("--single-line", {"action": "store_true", "help": "no value holds a line break"}))
    command("check", "check keys, references and domains", folder, out)
    command("publish", "check tables and put them in place of the published ones", folder,
            ("target", {"help": "folder of the published tables"}),
            ("--database", {"help": "catalogue database that gets the tables as well"}))
    command("author", "publications of an author name", folder, ("name", {}), out)
    command("authors", "publications of all names in a CSV list", folder, ("names", {}), out)
    command("sample", "most productive and random authors", folder,
            ("--top", {"type": int, "default": 100}),
            ("--random", {"type": int, "default": 100}),
            ("--seed", {"default": "0"}), out)
    command("graph", "build co-author graph, ranking and components", folder,
            ("--threshold", {"type": float, "action": "append", "default": []}),
            ("--buckets", {"type": int}), ("--table", {"help": "catalogue name of a bucketed graph"}))
    command("component", "component of one author id", folder, ("id", {"type": int}),
            ("--threshold", {"type": float, "help": "only edges above this weight count"}), out)
    command("export", "write property-graph files", folder, ("target", {}), out)
    return parser


def main(argv=None) -> None:
    args = _parser().parse_args(argv)
    spark = get_session(f"colophon {args.command}")

    def show(df, name=None):
        """The whole result: as files, or printed row by row."""
        if args.out:
            target = f"{args.out}/{name}" if name else args.out
            table_io.write_csv(df, target)
            print(f"written to {target}")
            return
        print(*df.columns, sep="\t")
        for row in df.toLocalIterator():
            print(*("" if value is None else value for value in row), sep="\t")

    try:
        _run(args, spark, show)
    finally:
        close_scratch(spark)


def _run(args, spark, show) -> None:
    if args.command == "profile":
        for name, df in ingest.profile_dump(spark, args.xml).items():
            print(name)
            show(df, name)
    elif args.command == "ingest":
        print(ingest.ingest(spark, args.xml, args.folder, args.strict, args.known))
    elif args.command == "load-csv":
        print(table_io.load_csv_tables(
            spark, args.csv, args.folder, multi_line=not args.single_line))
    elif args.command == "check":
        show(ingest.check(spark, args.folder))
    elif args.command == "author":
        show(authors.author_publications(args.name, **lookup.lookup_tables(spark, args.folder)))
    elif args.command == "authors":
        names = table_io.read_names(spark, args.names)
        show(authors.publications_of(names, **lookup.lookup_tables(spark, args.folder)))
    elif args.command == "sample":
        tables = table_io.read_tables(spark, args.folder, ("person", "author"))
        show(authors.benchmark_authors(
            tables["person"], tables["author"], args.top, args.random, args.seed))
    elif args.command == "graph":
        graph.build_graph(spark, args.folder, args.threshold, args.buckets, args.table)
    elif args.command == "component" and args.threshold is not None:
        show(graph.component_above(spark, args.folder, args.id, args.threshold))
    elif args.command == "component":
        labels = spark.read.parquet(f"{args.folder}/components")
        show(components.labelled_component(labels, args.id))
    elif args.command == "publish":
        print(ingest.publish(spark, args.folder, args.target, args.database))
    elif args.command == "export":
        show(graph.export(spark, args.folder, args.target))


if __name__ == "__main__":
    main()
