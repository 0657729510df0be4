"""Options that several jobs share."""

from __future__ import annotations

import argparse


def add_topic(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--topic", default="flight-events")
    parser.add_argument("--messages", help="folder of message files in place of Kafka, below it topic=<name>")
    parser.add_argument("--format", default="parquet", help="format of the message files")


def add_marts(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--marts", help="folder of the mart tables")
    parser.add_argument("--jdbc-url", help="database of the mart tables, in place of a folder")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password-env", help="environment variable that holds the password")
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")


def need_one(parser: argparse.ArgumentParser, args: argparse.Namespace, *names: str) -> None:
    if sum(getattr(args, name) is not None for name in names) != 1:
        options = " and ".join("--" + name.replace("_", "-") for name in names)
        parser.error(f"give one of {options}")


def jdbc_of(args: argparse.Namespace, env: dict[str, str]) -> dict[str, str] | None:
    if args.jdbc_url is None:
        return None
    jdbc = {"url": args.jdbc_url, "driver": args.jdbc_driver}
    if args.jdbc_user:
        jdbc["user"] = args.jdbc_user
    if args.jdbc_password_env:
        jdbc["password"] = env[args.jdbc_password_env]
    return jdbc
